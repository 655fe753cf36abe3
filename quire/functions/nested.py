"""Column expressions over the nested text of one paper: paragraphs, sections, figures.

All of them work inside the row, so no document is ever regrouped.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.arrays import bind

FIGURE_PREFIX = "FIGREF"
IMAGE_FIELDS = ("author", "width", "height", "url", "download_url")


def clean_paragraphs(body: Column) -> Column:
    """Paragraphs without citation spans. Reference spans that name a figure stay as ``figures_in_paragraph``,
    which is null when there is none."""
    def clean(paragraph):
        named = F.filter(paragraph["ref_spans"], lambda ref: ref["ref_id"].isNotNull())
        return F.struct(paragraph["section"].alias("section"), paragraph["text"].alias("text"),
                        bind(named, lambda refs: F.when(F.size(refs) > 0, refs)).alias("figures_in_paragraph"))
    return F.transform(body, clean)


def sections(paragraphs: Column, as_coded: bool = False) -> Column:
    """Paragraphs grouped into ``{section_title, paragraphs}``, sections in order of first appearance.

    With ``as_coded`` a paragraph whose title came up before goes to the latest section instead of its own.
    Titles are sorted with their positions, so each section is one slice: the work is n log n in the paragraphs.
    """
    # A title as a key that is never null.
    keyed = F.array_sort(F.transform(paragraphs, lambda p, i: F.struct(
        F.coalesce(F.concat(F.lit("t"), p["section"]), F.lit("n")).alias("key"), i.alias("at"))))
    title = lambda key: F.when(key.startswith("t"), F.substring(key, 2, 2**31 - 1)).alias("section_title")
    bare = lambda members: F.transform(members, lambda p: p.dropFields("section")).alias("paragraphs")

    def first_of_each(keyed):
        """(at, key, from): first position of each title, and where its run begins among the sorted ones."""
        runs = F.transform(keyed, lambda x, k: F.struct(
            x["at"].alias("at"), x["key"].alias("key"), k.alias("from"),
            ((k == 0) | (F.get(keyed, k - 1)["key"] != x["key"])).alias("new")))
        return F.filter(runs, lambda x: x["new"])

    def consecutive(starts):
        return F.transform(starts, lambda s, k: F.struct(title(s["key"]), bare(F.slice(
            paragraphs, s["at"] + 1, F.coalesce(F.get(starts, k + 1)["at"], F.size(paragraphs)) - s["at"]))))

    def by_title(env):
        made = F.transform(env["starts"], lambda s, k: F.struct(
            s["at"].alias("at"), title(s["key"]), bare(F.transform(
                F.slice(env["keyed"], s["from"] + 1,
                        F.coalesce(F.get(env["starts"], k + 1)["from"], F.size(env["keyed"])) - s["from"]),
                lambda x: F.get(env["paragraphs"], x["at"])))))
        in_order = F.array_sort(F.transform(made, lambda s, k: F.struct(s["at"].alias("at"), k.alias("k"))))
        return bind(made, lambda made: F.transform(in_order, lambda x: F.get(made, x["k"]).dropFields("at")))

    def group(keyed):
        starts = first_of_each(keyed)
        if as_coded:
            return bind(F.array_sort(starts), consecutive)
        return bind(starts, lambda starts: bind(F.struct(
            starts.alias("starts"), keyed.alias("keyed"), paragraphs.alias("paragraphs")), by_title))

    return F.when(paragraphs.isNotNull(), bind(keyed, group))


def add_images(figures: Column, images: Column) -> Column:
    """Figure map with the image fields of ``images`` (map from figure id to image, null where there is none)."""
    def enrich(key, figure):
        return bind(F.try_element_at(images, key), lambda image: F.struct(
            figure["text"].alias("text"), figure["type"].alias("type"),
            *[image[field].alias(field) for field in IMAGE_FIELDS]))
    return F.transform_values(figures, enrich)


def describe_references(paragraphs: Column, figures: Column) -> Column:
    """Figure references with the data of the figure they name: their own text becomes the caption and the
    figure's fields are added. References to unknown figures keep their text."""
    def describe(pair):
        ref, figure = pair["ref"], pair["figure"]
        known = figure.isNotNull()
        return F.struct(ref["start"].alias("start"), ref["end"].alias("end"), ref["ref_id"].alias("ref_id"),
                        F.when(known, figure["text"]).otherwise(ref["text"]).alias("text"),
                        F.when(known, ref["text"]).alias("caption"),
                        figure["type"].alias("type"), *[figure[field].alias(field) for field in IMAGE_FIELDS])
    def describe_all(figures):
        look_up = lambda ref: F.struct(ref.alias("ref"), F.try_element_at(figures, ref["ref_id"]).alias("figure"))
        return F.transform(paragraphs, lambda p: p.withField(
            "figures_in_paragraph", F.transform(F.transform(p["figures_in_paragraph"], look_up), describe)))
    return bind(figures, describe_all)


def list_figures(figures: Column) -> Column:
    """Figure map as an array with the key as ``fig_id``; null when empty. Figures proper keep only type,
    author and url, other entries such as tables keep their text."""
    def trim(entry):
        is_figure = entry["key"].startswith(FIGURE_PREFIX)
        value = entry["value"]
        return F.struct(entry["key"].alias("fig_id"), F.when(~is_figure, value["text"]).alias("text"),
                        value["type"].alias("type"), value["author"].alias("author"), value["url"].alias("url"))
    return F.when(F.size(figures) > 0, F.transform(F.map_entries(figures), trim))


def full_text(paragraphs: Column) -> Column:
    """All paragraph texts in one string."""
    return F.array_join(F.transform(paragraphs, lambda p: p["text"]), "\n")


IMAGE_STRUCT = T.StructType([T.StructField(name, T.IntegerType() if name in ("width", "height") else T.StringType())
                             for name in IMAGE_FIELDS])
