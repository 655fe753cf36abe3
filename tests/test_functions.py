import re

from pyspark.sql import functions as F

from quire.functions import arrays, text
from quire.operators import columns as C
from quire.operators.phrases import phrase_places, tag_keywords_of
from quire import schemas


def _apply(spark, values, kind, make):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in df.select(make(F.col("v"))).collect()]


def test_list_literal(spark):
    cases = {
        "['A','B']": ["A", "B"], "['A', \"O'Neil\"]": ["A", "O'Neil"], "[]": [], "['x\\xa0y']": ["x\xa0y"],
        "[None, 'a']": [None, "a"], None: None, "broken [": None, "['None', \"say None, x\"]": ["None", "say None, x"],
        "['a\\\\x41']": ["a\\x41"], "['it\\'s \"q\"']": ["it's \"q\""], "['tab\\t']": ["tab\t"],
        "['é', None, '\\xe9']": ["é", None, "é"],
    }
    assert _apply(spark, list(cases), "string", text.parse_list_literal) == list(cases.values())
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert df.agg(text.count_unparsed(F.col("v"), text.parse_list_literal(F.col("v")))).first()[0] == 1


def test_list_literal_of_many_items(spark):
    literal = "[" + ", ".join(["'name \\xe9'"] * 20000) + "]"
    assert len(_apply(spark, [literal], "string", text.parse_list_literal)[0]) == 20000


def test_split_multivalue(spark):
    assert _apply(spark, ["a|b", "a", None], "string", text.split_multivalue) == [["a", "b"], ["a"], None]
    assert _apply(spark, ["a|b", None], "string", lambda c: text.split_multivalue(c, null_as_empty=True)) == [
        ["a", "b"], [""]]


def test_dates(spark):
    assert [str(d) for d in _apply(spark, ["2020-02-03", "no", None], "string", text.parse_date)] == [
        "2020-02-03", "None", "None"]
    assert _apply(spark, ["2020-02-03", None], "string", lambda c: F.to_json(F.struct(
        arrays.extended_json_date(c).alias("d")))) == ['{"d":{"$date":"2020-02-03"}}', '{"d":{}}']


def test_email(spark):
    names = ["Ann Bell", "Ann Mary Bell", "Plato", "  Ann  Bell ", None, " "]
    assert _apply(spark, names, "string", lambda c: text.derive_email(c, "p_")) == [
        "AnnBell@gmail.com", "AnnMary@gmail.com", "p_Plato@gmail.com", "AnnBell@gmail.com", None, None]


def test_keywords(spark):
    texts = ["we use Spark and c++", "none", None, "We require a building on Linux with javascript", "Java, UI."]
    assert _apply(spark, texts, "string", text.tag_keywords) == [["C++", "SPARK"], [], [], [], ["JAVA", "UI"]]


def test_arrays(spark):
    assert _apply(spark, [["a", "b"], [], None], "array<string>", arrays.first_element) == ["a", None, None]
    assert _apply(spark, [["a", "b"], [], None], "array<string>", arrays.list_size) == [2, 0, 0]
    fields = [[("Biology",), ("Art",), ("Biology",)], None]
    assert _apply(spark, fields, "array<struct<category:string>>",
                  lambda c: arrays.distinct_field(c, "category")) == [["Biology", "Art"], []]
    assert _apply(spark, [{"a": "x", "b": None}], "map<string,string>", arrays.without_null_values) == [{"a": "x"}]


def test_conform(spark):
    df = spark.createDataFrame([("1", "1998.0", ["1", "x"]), ("z", "19x", None)], "id string, year string, ids array<string>")
    wanted = schemas.T.StructType.fromDDL("id bigint, year int, ids array<bigint>, title string")
    made = C.conform(df, wanted)
    assert made.dtypes == [("id", "bigint"), ("year", "int"), ("ids", "array<bigint>"), ("title", "string")]
    assert [tuple(r) for r in made.collect()] == [(1, 1998, [1, None], None), (None, None, None, None)]
    assert tuple(C.count_rejected_values(df, wanted.fields and schemas.T.StructType(wanted.fields[:2])).first()) == (1, 1)


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    made = C.require_not_null(df, ["id"])
    assert [f.nullable for f in made.schema] == [False, True] and made.count() == 1
    assert C.count_null_keys(df, ["id"]).first().rejected == 1


def test_prune(spark):
    df = spark.createDataFrame([(1, "k", "3", "1-2", "7")], "id long, key string, number string, pages string, volume string")
    assert C.prune_columns(df, ["id", "key", "missing"]).columns == ["id", "key"]


def test_phrases_by_their_rarest_token(spark):
    texts = ["Machine Learning and big data", "machine  learning", "C++ or C+ + or xC++ (c++)", "ASP.NET and .NET", "", None,
             "big big data data", "a.b.c a.b", "deep-learning; deep learning", "Ünïcode ünïcode 世界 x世界"]
    words = ["MACHINE LEARNING", "big data", "C++", ".net", "a.b", "a.b.c", "deep-learning", "learning", "世界", "++", "", None,
             "ünïcode ünïcode", "big", "unseen words", "Big"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocabulary = spark.createDataFrame([(w,) for w in words * 2], "word string")
    side = r"[^\W_]"
    expected = sorted((i, w, len(re.findall(r"[^\W_]+|[\W_]", t.lower()[:m.start()])))
                      for i, t in enumerate(texts) if t for w in set(words) if w
                      for m in re.finditer(f"(?=(?<!{side}){re.escape(w.lower())}(?!{side}))", t.lower()))
    found = phrase_places(docs, "id", "text", vocabulary).collect()
    assert sorted(map(tuple, found)) == expected and len(expected) > 20
    assert phrase_places(docs, "id", "text", vocabulary.limit(0)).isEmpty()
    assert phrase_places(docs.limit(0), "id", "text", vocabulary).isEmpty()
    many = spark.createDataFrame([(1, "x " * 100_000 + "needle in x")], "id int, text string")
    assert [r.keywords for r in tag_keywords_of(many, "id", "text", spark.createDataFrame(
        [("needle in",), ("x x",), ("x needle in x",)], "word string")).collect()] == [["needle in", "x needle in x", "x x"]]
