"""SQL for the queries that SQL can express, neighbours, url rules, piece ids, and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from quire.llm import pieces, queries, quality
from quire.llm.neighbours import nearest
from quire.llm.store import stored
from quire.llm.url_rules import SPAM, Rule, compiled, judged, matches
from test_llm_near_duplicates import brute_force
from test_llm_text_operators import loose, odd_documents
from test_llm_words import plain_set


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLES[name]) == []


def test_all_are_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert [n for n in range(1, 14) if sum(name.startswith(f"op{n}_") for name in names) != 1] == []
    assert "pipeline" in names


# --- nearest neighbours ---

def test_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 12)).astype(np.float32).tolist()
    vectors[20:40] = [vectors[20]] * 20          # ties
    vectors[60:80] = (np.array(vectors[60]) * (1 + rng.normal(size=(20, 12)) * 1e-5)).tolist()   # nearly equal
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, [0.0] * 12), (1100, [float("nan")] + [1.0] * 11), (1150, [None] + [1.0] * 11), (1200, []),
             (1250, [1.0, 2.0]), (None, [1.0] * 12), (150, vectors[150])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("query", F.lit("clash"))
    usable = {i: np.array(v, np.float32).astype(float) for i, v in rows[:300]}
    for query_rows, candidate_rows, strip in ((2048, 4096, 1024), (3, 40, 7)):
        monkeypatch.setattr("quire.llm.neighbours.QUERY_ROWS", query_rows)
        monkeypatch.setattr("quire.llm.neighbours.CANDIDATE_ROWS", candidate_rows)
        made = {}
        for r in nearest(frame, F.col("vec_id") % 50 == 0, 5).collect():
            made.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert sorted(made) == [0, 50, 100, 150, 200, 250]
        for q, found in made.items():
            a = usable[q]
            def dot(x, y):
                total = 0.0
                for s, t in zip(x.tolist(), y.tolist()):
                    total += s * t
                return total
            scores = {i: dot(a, b) / np.sqrt(dot(a, a) * dot(b, b)) for i, b in usable.items() if i != q}
            best = sorted(scores, key=lambda i: (-scores[i], i))[:5]
            assert sorted(found) == [(k + 1, i, scores[i]) for k, i in enumerate(best)]
    few = nearest(frame.filter("vec_id IN (0, 7)"), F.col("vec_id") % 50 == 0, 5).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 7)]
    assert nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- url rules ---

def test_url_rules(spark):
    urls = ["http://Blog.Example.ORG/es/1", "https://example.org/en/1499?x", "https://example.org", "http://org/x", "notexample.org/es/",
            "http://badexample.org/es/", "ftp://a.com/fr/", "http://a.com/FR/", "http://a.com/de/x#y", "http://x.net/casino-win/1",
            "http://x.net/casino-wins/1", "http://x.net?u=http://y.org/", "", None, "http://", "://h/p?q", "http://CASINO-WIN.net", "a://b/\n"]
    rules = [*queries.LISTED, *SPAM, Rule("*net*", "allow")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls + urls)], "page_id long, url string").withColumn("rule", F.lit(1))
    made = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(pages, rules).collect()}
    assert len(made) == 2 * len(urls) and all(made[i] == made[i + len(urls)] for i in range(len(urls)))
    assert made[0] == ("blog.example.org", "/es/1", "||example.org/es/", "block")
    assert made[1] == ("example.org", "/en/1499", "||example.org/en/1", "block")
    assert made[2] == ("example.org", "", None, "allow") and made[3] == ("org", "/x", "||org/", "allow")
    assert made[4] == ("", "", None, "allow") and made[5] == ("badexample.org", "/es/", "||org/", "allow")
    assert made[6][2:] == ("||com/fr/", "allow") and made[7][2:] == (None, "allow") and made[8][2:] == ("||com/de/", "block")
    assert made[9][2:] == ("^casino-win^", "block") and made[10][2:] == ("*net*", "allow") and made[11][:2] == ("x.net", "")
    assert made[12] == made[13] == ("", "", None, "allow") and made[15][:2] == ("h", "/p") and made[16][2:] == ("^casino-win^", "block")
    assert judged(pages.limit(0), rules).count() == 0


def test_rules_keep_their_whole_tokens(spark):
    def tokens(pattern):
        return compiled(spark, [Rule(pattern, "block")]).first().tokens
    assert tokens("||example.org/en/1") == ["en", "example", "org"]
    assert tokens("^a-b*c^d") == ["a", "c"] or tokens("^a-b*c^d") == ["a"]
    assert tokens("*x*") == []


def test_many_rules_from_a_table(spark):
    rules = spark.range(50_000).select(F.format_string("||site%d.example/a.b", "id").alias("pattern"),
                                       F.when(F.col("id") % 2 == 0, "block").otherwise("allow").alias("verdict"))
    rules = rules.union(rules.limit(3)).union(spark.createDataFrame(
        [(None, "block"), ("x", None)], "pattern string, verdict string"))
    pages = spark.createDataFrame([(f"http://www.SITE{i}.example/a.b/{i}",) for i in range(0, 50_000, 997)]
                                  + [("http://site4.example/axb",), ("http://site5.example/a.b",)] * 200, "url string")
    made = judged(pages, rules).collect()
    assert len(made) == pages.count()
    for row in made:
        fits = row.path.startswith("/a.b")
        number = int(row.host.split(".")[-2].removeprefix("site"))
        assert row.rule == (f"||site{number}.example/a.b" if fits else None)
        assert row.verdict == ("block" if fits and number % 2 == 0 else "allow")


def test_rules_without_candidates_are_not_run(spark):
    urls = spark.createDataFrame([("http://a.b/c",)], "url string")
    assert matches(urls, [Rule("||zzz.org/", "block")]).count() == 0


# --- piece ids ---

sentencepiece = pytest.importorskip("sentencepiece")


def unigram_model():
    """A small unigram model, put together by hand."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    rows += [(p, s, 1) for p, s in (("▁", -3.0), ("a", -3.1), ("b", -3.2), ("ab", -4.05), ("▁a", -4.2), ("▁ab", -5.5), ("aba", -5.1), ("c", -6.0))]
    for piece, score, kind in rows:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = True
    proto.trainer_spec.vocab_size = len(rows)
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    return proto.SerializeToString()


@pytest.mark.parametrize("model", ["bpe", "unigram"])
def test_ids_are_those_of_the_library(model, monkeypatch):
    content = open(pieces.MODEL, "rb").read() if model == "bpe" else unigram_model()
    library = sentencepiece.SentencePieceProcessor(model_proto=content)
    rng = random.Random(2)
    parts = ["a", "b", "ab", "c", "the", "ing", " ", "  ", "\n", "é", "日", "😀", "1", "\0", "x" * 4, "￿"]
    texts = ["", " ", "a", "\0", " " * 50, "▁a ▁", "hello world"] + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(1500)]
    for indexed, remembered in ((1 << 17, 1 << 19), (50, 20)):
        monkeypatch.setattr(pieces, "INDEXED", indexed)
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        encoder, some = pieces.Encoder(pieces.vocabulary(content)), texts if indexed > 50 else texts[:120]
        for at in range(0, len(some), 40):
            part = some[at:at + 40]
            ids, first = encoder.encode(pa.array(part))
            made = [ids[a:b].tolist() for a, b in zip(first, first[1:])]
            assert made == library.encode(part)
            assert pieces.decoded(ids, first, encoder.v) == [t.replace("▁", " ") for t in part]


def test_suffixes_of_a_long_word_are_sorted_without_a_key():
    rng = np.random.default_rng(5)
    for n, letters in ((0, 3), (1, 3), (400, 2), (500, 30), (300, 1)):
        text = rng.integers(1, letters + 1, n)
        short, long = (pieces.suffix_order(text, 8, bits) for bits in (64, 1))
        of = lambda order: [text[i:i + 8].tolist() for i in order]
        assert of(short) == of(long) == sorted(text[i:i + 8].tolist() for i in range(n))


def test_a_word_of_millions_of_letters():
    """No blank in it, so that it is one index, beyond what sorts as one key."""
    content = open(pieces.MODEL, "rb").read()
    rng = random.Random(7)
    text = "".join(rng.choices(["the", "ing", "a", "日本", "\t", "é", "xy", "\n", "1"], k=1_300_000))
    assert len(text) > 1 << 21 and " " not in text
    encoder = pieces.Encoder(pieces.vocabulary(content))
    ids, first = encoder.encode(pa.array([text, "short"]))
    assert pieces.decoded(ids, first, encoder.v) == [text, "short"]
    assert ids[:first[1]].tolist() == sentencepiece.SentencePieceProcessor(model_proto=content).encode(text)


def test_piece_frames(spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = queries.op6_sentencepiece(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == 1000 and all(r.exact and r.n_ids == len(r.ids) for r in rows)
    assert all(r.ids == library.encode(texts[r.doc_id]) for r in rows)
    docs = odd_documents(spark).withColumn("copy", F.col("text"))
    coded = pieces.encode(docs)
    assert coded.columns == [c for c in docs.columns if c != "ids"] + ["ids"]
    back = pieces.decode(coded, into="back").collect()
    assert len(back) == docs.count() and all(r.back == r.copy for r in back)
    assert pieces.encode(docs.limit(0)).count() == 0


# --- pipeline ---

def test_pipeline_stage_by_stage(spark, folder):
    """Every stage against a plain version of it on what the stage before kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        made[name] = {r.doc_id: r for r in docs.collect()}
        assert len(made[name]) == docs.count()
        if name != "sentencepiece_encoding":
            assert docs.columns == columns
    source = spark.read.parquet(f"{folder}/documents.parquet")
    scores = quality.score(source, queries.quality_model(spark, source, folder), keep=["doc_id"]).collect()
    stage1 = made["quality_classifier"]
    assert set(stage1) == {r.doc_id for r in scores if r.score >= 0.3}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [i for i, y in labels.items() if y == 1]
    assert sum(i in stage1 for i in good) >= 0.99 * len(good)
    groups = brute_force([(i, r.text) for i, r in stage1.items()], 5, 80)
    stage2 = made["minhash_near_dedup"]
    assert set(stage2) == {i for i, (_, c) in groups.items() if i == c} and all(stage2[i] == before[i] for i in stage2)
    items = [plain_set(loose(r.text), 5) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    tainted = {i for i, r in stage2.items() for item in items if 100 * len(item & plain_set(loose(r.text), 5)) >= 80 * len(item)}
    stage3, stage4 = made["benchmark_decontamination"], made["secret_redaction"]
    assert tainted and set(stage3) == set(stage2) - tainted
    found = {r.doc_id: r.spans for r in queries.op10_secret_scan(spark, folder).collect()}
    assert set(stage4) == set(stage3)
    for i, r in stage4.items():
        text, end, parts = stage3[i].text, 0, []
        for a, b in sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in filter(None, found[i].split(","))):
            if not parts or a > end:
                parts.append([a, b])
            else:
                parts[-1][1] = max(b, end)
            end = parts[-1][1]
        for a, b in reversed(parts):
            text = text[:a] + "[SECRET]" + text[b:]
        assert r.text == text and r.n_chars == len(text) and (r.lang, r.source) == (stage3[i].lang, stage3[i].source)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    last = made["sentencepiece_encoding"]
    assert set(last) == set(stage4) and all(r.ids == library.encode(stage4[i].text) and r.exact for i, r in last.items())


def test_pipeline_with_odd_rows(spark, tmp_path):
    docs = odd_documents(spark).union(spark.createDataFrame([(50, "token=abcdefgh " + "w" * 30)], "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in odd_documents(spark).columns[2:]})).withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("long")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    made = corpus_pipeline.run(spark, str(tmp_path))
    # Rows that are alike in id and text are one; nothing else goes, as all scores are 0.5.
    assert made.count() == docs.dropDuplicates(["doc_id", "text"]).count() and made.filter("exact = false").isEmpty()
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, frame, str(tmp_path))
            assert kept.columns == docs.columns and kept.count() <= frame.count()


def test_pipeline_with_columns_of_any_name(spark, tmp_path):
    names = ["_quality", "row", "row_", "a.b", "document", "score", "spans", "_text_to_score", "kept", "Blob`x"]
    docs = spark.createDataFrame([(i, f"some plain text number {i} token=abcdefgh", "en", None, 5) for i in range(20)],
                                 "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {name: F.concat(F.lit(name), F.col("doc_id")) for name in names})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), "stage")
        for row in docs.collect():
            assert all(row[name] == f"{name}{row.doc_id}" for name in names)
    assert docs.count() > 0 and docs.filter("text LIKE '%[SECRET]%'").count() == docs.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
