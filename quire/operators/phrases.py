"""Which phrases of a vocabulary table a text contains.

A text is a list of tokens with positions: runs of letters and digits, and every other character by itself. A phrase is
looked for at its rarest token only, where it is verified by the tokens at the neighbouring positions.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]"
#: Bits of the filter that keeps most tokens out of the join; its size is fixed, and a false hit fails in the join.
FILTER_BITS = 1 << 20


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


#: How far from its rarest token a phrase is checked for a second token before it moves.
NEAR = 2


def _slot(h: Column) -> Column:
    return F.floor(F.pmod(h, F.lit(FILTER_BITS)) / 64).cast("int")


def _bit(h: Column) -> Column:
    return F.pmod(h, F.lit(64)).cast("int")


def _filter(hashes: DataFrame) -> Column:
    """A filter of `FILTER_BITS` bits over the column ``h``, as an array that Spark makes when the query runs."""
    words = hashes.select(_slot(F.col("h")).alias("slot"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("h"))).alias("bit"))
    held = words.groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    bits = held.agg(F.map_from_entries(F.collect_list(F.struct("slot", "bits"))).alias("m"))
    return bits.select(F.transform(F.sequence(F.lit(0), F.lit(FILTER_BITS // 64 - 1)),
                                   lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("b")).scalar()


def _with_second(token: Column, distance: Column, second: Column) -> Column:
    return F.xxhash64(token, distance, second)


def rarest_tokens(phrases: DataFrame, texts: DataFrame, text_col: str) -> DataFrame:
    """(word, phrase, token, k): every phrase with its tokens, its rarest token in the texts and the position of it."""
    split = phrases.select("word").filter("word <> ''").distinct().withColumn("phrase", tokens(F.col("word")))
    # Tokens are counted before they are shuffled, and only those of the vocabulary are kept.
    counts = texts.select(F.explode(tokens(F.col(text_col))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    places = split.select("word", "phrase", F.posexplode("phrase").alias("k", "token"))
    rarest = places.join(counts, "token").groupBy("word", "phrase").agg(
        F.min(F.struct("n", "k", "token")).alias("r"), F.count("*").alias("known"))
    # A phrase with a token that no text has cannot occur.
    return rarest.filter(F.col("known") == F.size("phrase")).select("word", "phrase", "r.token", "r.k")


def phrase_places(texts: DataFrame, id_col: str, text_col: str, phrases: DataFrame) -> DataFrame:
    """(id_col, word, at): every place, as a position of tokens, where a text has a phrase of (word), whatever the case,
    with no letter or digit right before or behind it."""
    rules = rarest_tokens(phrases, texts, text_col)
    # The second token is up to NEAR places behind the rarest one, or before it where that is the last one; a phrase of
    # one token has distance 0.
    behind = F.least(F.size("phrase") - 1 - F.col("k"), F.lit(NEAR))
    distance = F.when(behind > 0, behind).otherwise(-F.least(F.col("k"), F.lit(NEAR))).cast("int")
    seconds = rules.select(_with_second(F.col("token"), distance, F.get("phrase", F.col("k") + distance)).alias("h"))
    reach = rules.agg(F.coalesce(F.max("k"), F.lit(0)).alias("left"),
                      F.coalesce(F.max(F.size("phrase") - F.col("k")), F.lit(1)).alias("right"))
    listed = (texts.select(id_col, tokens(F.col(text_col)).alias("tokens"))
              .withColumn("bits", _filter(rules.select(F.xxhash64("token").alias("h"))))
              .withColumn("seconds", _filter(seconds)).withColumn("left", reach.select("left").scalar())
              .withColumn("right", reach.select("right").scalar()))
    is_in = lambda name, h: F.coalesce(F.getbit(F.get(F.col(name), _slot(h)), _bit(h)) == 1, F.lit(False))
    second_at = lambda x, d: is_in("seconds", _with_second(x["token"], F.lit(d), F.get("tokens", x["i"] + d)))
    held_at = F.filter(F.transform("tokens", lambda t, i: F.struct(t.alias("token"), i.alias("i"))),
                       lambda x: is_in("bits", F.xxhash64(x["token"])) & reduce(
                           lambda a, b: a | b, [second_at(x, d) for d in range(-NEAR, NEAR + 1)]))
    first = lambda i: F.greatest(i - F.col("left") - 1, F.lit(0))
    near = F.transform(held_at, lambda x: F.struct(
        x["token"].alias("token"), x["i"].alias("i"), (x["i"] - first(x["i"])).alias("before"),
        F.slice(F.col("tokens"), first(x["i"]) + 1, F.col("left") + F.col("right") + 2).alias("near")))
    found = listed.select(id_col, F.explode(near).alias("x")).select(id_col, "x.*").join(rules, "token")
    begin = F.col("before") - F.col("k")
    outside = lambda place: ~F.coalesce(F.get("near", place).rlike(r"^[\p{L}\p{N}]"), F.lit(False))
    matched = (found.filter(begin >= 0).filter(F.slice("near", F.greatest(begin, F.lit(0)) + 1, F.size("phrase")) == F.col("phrase"))
               .filter(F.when(begin > 0, outside(begin - 1)).otherwise(True) & outside(begin + F.size("phrase"))))
    return matched.select(id_col, "word", (F.col("i") - F.col("k")).alias("at"))


def tag_keywords_of(texts: DataFrame, id_col: str, text_col: str, vocabulary: DataFrame) -> DataFrame:
    """(id_col, keywords): the words and phrases of a vocabulary table (word) that a text contains, sorted. The table
    may be of any size; only tokens that may be the rarest one of a phrase meet it, with their neighbours."""
    found = phrase_places(texts, id_col, text_col, vocabulary).select(id_col, "word").distinct()
    return found.groupBy(id_col).agg(F.sort_array(F.collect_list("word")).alias("keywords"))
