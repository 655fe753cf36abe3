"""Assembling nested publication documents from papers, external authors, texts, images and citation edges."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import nested
from quire.functions.arrays import distinct_field, extended_json_date, or_empty, without_null_values
from quire.functions.text import KEYWORDS, derive_email, tag_keywords
from quire.operators.blocks import GATHERED_BYTES, byte_block, finely, with_start
from quire.operators.edges import proper_edges, recount_in_degree
from quire.operators.rows import dedupe_first, first_n_matching
from quire.sinks.tables import write_parquet


#: Bytes of citations or paragraphs in a row, at most.
ROW_BYTES = 64 << 20


def embed_authors(papers: DataFrame, authors: DataFrame, id_col: str, fallback_prefix: str,
                  domain: str = "gmail.com", drop: tuple[str, ...] = ("updated", "aliases")) -> DataFrame:
    """Replace the author stubs of each paper by the full author records plus an email, in the same order.

    Authors without an id or without a record vanish; a paper left with none keeps ``[]``. Of several records
    for one id the first by all their columns is taken. ``papers`` holds one row per ``id_col``.
    """
    fields = [c for c in authors.columns if c not in drop]
    records = dedupe_first(authors, ["authorid"], [c for c in authors.columns if c != "authorid"]).select(
        F.col("authorid"), F.struct(*fields).alias("record"))
    stubs = papers.select(id_col, F.posexplode("authors").alias("pos", "stub")).select(
        id_col, "pos", F.col("stub.authorId").try_cast("bigint").alias("authorid"),
        derive_email(F.col("stub.name"), fallback_prefix, domain).alias("email"))
    found = stubs.join(records, "authorid").select(
        id_col, "pos", F.col("record").withField("email", F.col("email")).alias("author"))
    # The list comes out of one row of papers, so it fits into one row again.
    lists = (finely(found, id_col).groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("pos", "author"))).alias("_items"))
             .select(id_col, F.col("_items.author").alias("_authors")))
    kind = lists.schema["_authors"].dataType.simpleString()
    return (papers.join(lists, id_col, "left")
            .withColumn("authors", or_empty(F.col("_authors"), kind)).drop("_authors"))


def clean_texts(texts: DataFrame) -> DataFrame:
    """Texts (body_text, ref_entries, keys) with cleaned ``paragraphs`` and the figure map ``figures``."""
    return texts.withColumns({
        "paragraphs": nested.clean_paragraphs(F.col("body_text")),
        "figures": without_null_values(F.col("ref_entries")),
    }).drop("body_text", "ref_entries")


def assign_images(texts: DataFrame, images: DataFrame, on: str) -> DataFrame:
    """(on, images map): an image for every figure, chosen by document and figure id alone: the first 15 hex digits of
    the MD5 of ``document:figure``, modulo the number of images, so that any engine finds the same one.

    ``images`` numbers its rows 0..n-1 in ``idx``. Only ids are exploded and shuffled, not the texts; Spark
    broadcasts the image table when its measured size allows and shuffles it otherwise.
    """
    figures = (texts.select(on, F.explode(F.map_keys("figures")).alias("fig_id"))
               .filter(F.col("fig_id").startswith(nested.FIGURE_PREFIX)))
    n_images = images.agg(F.count("*").alias("n")).scalar()
    image = F.struct(*nested.IMAGE_FIELDS).alias("image")
    digits = F.substring(F.md5(F.concat_ws(":", F.col(on).cast("string"), "fig_id").cast("binary")), 1, 15)
    chosen = (figures.withColumn("idx", F.conv(digits, 16, 10).cast("long") % n_images)
              .join(images.select(F.col("idx").cast("long").alias("idx"), image), "idx"))
    # The figures come out of one row of texts, so the map fits into one row again.
    return (chosen.groupBy(on).agg(F.collect_list(F.struct("fig_id", "image")).alias("_pairs"))
            .select(on, F.map_from_entries("_pairs").alias("images")))


def content(paragraphs: Column, figures: Column, vocabulary: list[str] = KEYWORDS,
            as_coded: bool = False) -> Column:
    """The content struct of a document: sections, list of figures, keywords."""
    return F.struct(
        nested.sections(paragraphs, as_coded).alias("sections"),
        nested.list_figures(figures).alias("list_of_figures"),
        tag_keywords(nested.full_text(paragraphs), vocabulary).alias("keywords"))


def attach_content(papers: DataFrame, texts: DataFrame, on: str, images: DataFrame | None = None,
                   vocabulary: list[str] = KEYWORDS, as_coded: bool = False) -> DataFrame:
    """Papers with ``content`` from the cleaned texts and with their fields of study as plain distinct names.

    All joins are on ``on``, so the texts move once. A paper without a text has no content; of several texts of one
    paper the one with the smallest hash counts.
    """
    texts = dedupe_first(texts.withColumn("_hash", F.xxhash64(F.to_json(F.struct("paragraphs")))), [on], ["_hash"]).drop(
        "_hash")
    if images is not None:
        texts = texts.join(assign_images(texts, images, on), on, "left")
    else:
        none = F.lit(None).cast(f"map<string,{nested.IMAGE_STRUCT.simpleString()}>")
        texts = texts.withColumn("images", none)
    texts = texts.withColumn("figures", nested.add_images(F.col("figures"), F.col("images")))
    texts = texts.withColumn("paragraphs", nested.describe_references(F.col("paragraphs"), F.col("figures")))
    body = texts.select(on, content(F.col("paragraphs"), F.col("figures"), vocabulary, as_coded).alias("content"))
    return (papers.join(body, on, "left")
            .withColumn("s2fieldsofstudy", distinct_field(F.col("s2fieldsofstudy"), "category")))


def citation_records(documents: DataFrame, id_col: str, title_col: str, authors: Column) -> DataFrame:
    """(end_id, size, citation{reference_id, title, authors[]}): what a citing document stores of a cited one, and the
    bytes of its text with 24 for each value."""
    bytes_of = lambda text: F.coalesce(F.octet_length(text), F.lit(0)) + 24
    names = F.aggregate(authors, F.lit(0), lambda total, name: total + bytes_of(name))
    return documents.select(
        F.col(id_col).alias("end_id"),
        (bytes_of(F.col(title_col)) + F.coalesce(names, F.lit(0)) + 24).cast("long").alias("size"),
        F.struct(F.col(id_col).alias("reference_id"), F.col(title_col).alias("title"), authors.alias("authors"))
        .alias("citation"))


def _by_length(cited: DataFrame, edges: DataFrame, among: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Edges of documents whose citations fit into one row even if each were as long as the longest of all, and all
    other edges. Only edges are counted for this, their citations are not looked up."""
    most = cited.groupBy("end_id").agg(F.sum("size").alias("size")).agg(F.max("size")).scalar()
    long = (among.groupBy("start_id").agg(F.count("*").alias("_n")).filter(F.col("_n") * most > limit)
            .select("start_id", F.lit(True).alias("_long")))
    marked = edges.select("start_id", "end_id").join(long, "start_id", "left")
    return marked.filter(F.col("_long").isNull()).drop("_long"), marked.filter("_long").drop("_long")


def citations_in_parts(cited: DataFrame, edges: DataFrame, among: DataFrame,
                       limit: int = ROW_BYTES) -> tuple[DataFrame, DataFrame]:
    """(start_id, part, citation) from distinct edges (start_id, end_id), and (start_id, part) of all documents that have
    other parts than 0; edges to unknown ids drop out. The citations of a part have up to ``limit`` bytes, or it is one
    larger citation. Parts follow the reference ids, their numbers rise and may have gaps. Documents whose citations fit
    into one row have part 0 only.

    With a large limit few documents may need several rows. Only their citations are sized and numbered, those of all
    others are looked up once. Edges are counted in ``among``, a table that holds them all, made without a join on
    start_id, so that such a join may be split."""
    few, many = _by_length(cited, edges, among, limit) if limit >= GATHERED_BYTES else (None, edges)
    sized = with_start(many.select("start_id", "end_id").join(cited, "end_id"), ["start_id"], "end_id", "size", limit)
    found = sized.select("start_id", byte_block(F.col("size"), limit).alias("part"), "citation")
    parts = found.select("start_id", "part").distinct()
    if few is not None:
        whole = few.join(cited.select("end_id", "citation"), "end_id")
        found = whole.select("start_id", F.lit(0).cast("long").alias("part"), "citation").unionByName(found)
    return found, parts


def embed_citations(documents: DataFrame, cited: DataFrame, edges: DataFrame, known: DataFrame, id_col: str,
                    limit: int = ROW_BYTES) -> DataFrame:
    """Documents with their ``citations`` (``[]`` if none) and ``referencecount`` recounted from the edges that
    point to them; ``influentialcitationcount`` goes away. Self-citations, repeats and edges from or to other
    documents do not count.

    A document whose citations exceed ``limit`` bytes has a row for each ``part`` of them (`citations_in_parts`), which
    repeats its other columns; all others have one, part 0. Rows and lists meet by id and part, so that a document
    with very many citations is spread.

    ``cited`` comes from `citation_records` and ``known`` holds the document ids. Both are taken from early, slim
    forms of the documents, so that their texts are not built again for them.
    """
    sources = known.select(F.col(id_col).alias("start_id"))
    proper = proper_edges(edges)
    inside = proper.join(sources, "start_id", "left_semi")
    found, parts = (df.withColumnRenamed("start_id", id_col) for df in citations_in_parts(cited, inside, proper, limit))
    lists = finely(found, id_col, "part").groupBy(id_col, "part").agg(F.sort_array(F.collect_list("citation")).alias("citations"))
    kind = lists.schema["citations"].dataType.simpleString()
    counted = recount_in_degree(documents.drop("influentialcitationcount"), inside, id_col, "referencecount")
    rows = counted.join(parts, id_col, "left").withColumn("part", F.coalesce("part", F.lit(0).cast("long")))
    return rows.join(lists, [id_col, "part"], "left").withColumn("citations", or_empty(F.col("citations"), kind))


def with_extended_dates(documents: DataFrame, columns: list[str]) -> DataFrame:
    """Dates as ``{"$date": ...}``."""
    return documents.withColumns({name: extended_json_date(F.col(name)) for name in columns})


def build_documents(papers: DataFrame, authors: DataFrame, texts: DataFrame, images: DataFrame, edges: DataFrame,
                    fallback_prefix: str, n: int | None = None, id_col: str = "corpusid",
                    vocabulary: list[str] = KEYWORDS, as_coded: bool = False,
                    limit: int = ROW_BYTES, scratch: str | None = None) -> DataFrame:
    """The whole document preparation; ``texts`` carries ``id_col``, ``n`` keeps the first papers by id, and ``limit``
    bounds the bytes of citations in a row (`embed_citations`).

    Papers with their authors are used by four later steps. With ``scratch``, a new folder on storage that all executors
    share, they are written there at once and read from then on; the result reads them as well. Without it, every step
    builds them anew.
    """
    chosen = first_n_matching(papers, F.col("externalids.DBLP").isNotNull(), n, [id_col])
    documents = embed_authors(chosen, authors, id_col, fallback_prefix)
    if scratch is not None:
        write_parquet(documents, scratch)
        chosen = documents = documents.sparkSession.read.schema(documents.schema).parquet(scratch)
    cited = citation_records(documents, id_col, "title", F.col("authors.name"))
    documents = attach_content(documents, clean_texts(texts), id_col, images, vocabulary, as_coded)
    documents = embed_citations(documents, cited, edges, chosen, id_col, limit)
    return with_extended_dates(documents, ["publicationdate", "updated"])


def section_sizes(paragraphs: DataFrame, doc: str, pos: str, title: str) -> DataFrame:
    """(doc, title, first_pos, paragraphs): sections of paragraphs kept as rows, counted before the shuffle."""
    return paragraphs.groupBy(doc, title).agg(F.min(pos).alias("first_pos"), F.count("*").alias("paragraphs"))


def number_sections(paragraphs: DataFrame, doc: str, pos: str, title: str, block: int = 100_000) -> DataFrame:
    """Add ``section_no`` as coded: how many different titles have come up so far in the document.

    A running count over a whole document would put a huge one into a single task. The section starts are few;
    they are counted per block of ``block`` positions, blocks are summed up, and the running count stays inside
    a block.
    """
    in_block = F.expr(f"cast(`{pos}` div {block} as bigint)")
    starts = (paragraphs.groupBy(doc, title).agg(F.min(pos).alias(pos))
              .select(doc, in_block.alias("_block"), pos))
    earlier = Window.partitionBy(doc).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    running = (Window.partitionBy(doc, "_block").orderBy(pos, F.desc("_start"))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A block without a start takes the count of the latest one before it, so every block gets a row here.
    blocks = (paragraphs.select(doc, in_block.alias("_block")).distinct()
              .join(starts.groupBy(doc, "_block").agg(F.count("*").alias("_n")), [doc, "_block"], "left")
              .select(doc, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    rows = (paragraphs.withColumns({"_block": in_block, "_start": F.lit(0)})
            .unionByName(starts.withColumn("_start", F.lit(1)), allowMissingColumns=True)
            .withColumn("_in_block", F.sum("_start").over(running)).filter("_start = 0"))
    return (rows.join(blocks, [doc, "_block"])
            .withColumn("section_no", F.col("_in_block") + F.col("_before"))
            .drop("_block", "_start", "_in_block", "_before"))


def aggregate_sections(paragraphs: DataFrame, doc: str, pos: str, title: str, text: str,
                       as_coded: bool = False, limit: int = ROW_BYTES) -> DataFrame:
    """(doc, part, sections[{section_title, paragraphs[]}]) from paragraphs kept as rows, one row for each position.

    A document of up to ``limit`` bytes of text is one row, part 0. A larger one is cut by its running bytes into parts
    of up to ``limit`` bytes, or one larger paragraph; a section that spans parts appears in each of them. Part numbers
    rise with the positions and may have gaps. Within a row, sections come in order of first appearance and paragraphs
    in order of position.
    """
    sized = paragraphs.withColumn("_size", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    rows = (with_start(sized, [doc], pos, "_size", limit).withColumn("part", byte_block(F.col("_size"), limit))
            .drop("start", "_size"))
    position = F.col(pos).alias("pos")
    if as_coded:
        numbered = number_sections(rows, doc, pos, title)
        starts = numbered.groupBy(doc, "section_no").agg(F.min_by(title, pos).alias("section_title"))
        rows = numbered.join(starts, [doc, "section_no"])
        keys = [doc, "part", "section_no", "section_title"]
        order = F.col("section_no")
    else:
        keys = [doc, "part", F.col(title).alias("section_title")]
        order = F.col("_p")[0]["pos"]
    grouped = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(position, F.col(text).alias("text")))).alias("_p"))
    section = F.struct(order.alias("section_no"), "section_title", F.col("_p.text").alias("paragraphs")).alias("section")
    return (grouped.select(doc, "part", section).groupBy(doc, "part")
            .agg(F.sort_array(F.collect_list("section")).alias("_sections"))
            .select(doc, "part", F.transform("_sections", lambda s: s.dropFields("section_no")).alias("sections")))
