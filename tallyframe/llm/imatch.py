"""Document fingerprints after I-Match, in DataFrame operations only.

A term's document frequency is counted over all distinct texts. Terms within a band of
inverse document frequencies make the lexicon. It is drawn into random parts
several times, each time from a smaller share of the lexicon, so that short and
long texts find parts in which they have few terms. The set of distinct terms of a
text in a part is hashed; the hashes of all parts are the fingerprint. Two fingerprints are as alike as the share of parts, of those
where either text has a term, on which they agree. A text with terms, but none of the lexicon, has
hashes of its whole set of terms in all parts.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .scratch import Scratch

#: Shares of the distinct texts that a lexicon term is found in.
BAND = (0.0005, 0.2)
PARTS = 64
#: Each draw takes the terms whose hash ends in so many zero bits.
DRAWS = (0, 3, 6)
#: Ranges of ids in which documents get their follower, at least; more if they would hold more text than that.
RANGES = 200
RANGE_BYTES = 256 << 20
#: Hashes of texts with copies are sent to all tasks up to this number, and joined by shuffle beyond.
BROADCAST_TEXTS = 1_000_000
_DIGITS = 4
_EMPTY = "0" * _DIGITS


def _terms(text: Column) -> Column:
    """Hashes of the distinct words of a text, A-Z lower-cased."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def _copied(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """copied, copies: the hash and the number of rows of each text with several rows; and how many texts there are."""
    texts = scratch.keep(docs.groupBy(_text_hash().alias("copied")).agg(F.count("*").alias("copies")))
    return texts.where("copies > 1"), texts.count()


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def lexicon(docs: DataFrame, scratch: Scratch, band: tuple[float, float] = BAND) -> DataFrame:
    """Hashes of the terms found in a share of the distinct texts within the band.

    Its size is bounded by the mean number of distinct terms of a text divided
    by the lower share, however many documents there are. Texts are told apart
    by 64-bit hashes. Each copy of a text counts as its share of one text, so
    that no text is shuffled to find its copies.
    """
    copied, n_texts = _copied(docs, scratch)
    rows = docs.select("text", _text_hash().alias("hash"))
    if copied.count() <= BROADCAST_TEXTS:
        weighed = rows.join(F.broadcast(copied), F.col("hash") == F.col("copied"), "left")
    else:
        # texts with over a thousandth of the rows, fewer than 1,000, are sent to all tasks; their rows are spread
        often = copied.where(F.col("copies") * 1000 > docs.count())
        seldom = copied.join(F.broadcast(often.select("copied")), "copied", "left_anti").select(F.col("copied").alias("other"), F.col("copies").alias("own"))
        weighed = rows.join(F.broadcast(often), F.col("hash") == F.col("copied"), "left")
        key = F.when(F.col("copied").isNull(), F.col("hash")).otherwise(F.xxhash64("hash", F.monotonically_increasing_id()))
        weighed = weighed.withColumn("key", key).join(seldom, F.col("key") == F.col("other"), "left").withColumn("copies", F.coalesce("copies", "own"))
    found = weighed.select("copies", F.explode(_terms(F.col("text"))).alias("term")).groupBy("term")
    # the shares of a text add up to one but for rounding
    counted = found.agg((F.count_if(F.col("copies").isNull()) + F.round(F.coalesce(F.sum(1 / F.col("copies")), F.lit(0.0)))).alias("n"))
    low, high = max(1.0, band[0] * n_texts), max(1.0, band[1] * n_texts)
    return counted.where(F.col("n").between(low, high)).select("term")


def _cut_points(rows: DataFrame) -> list[int]:
    """Approximate quantiles of the ids, so many that a range holds about RANGE_BYTES of text."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(RANGES, math.ceil(size / RANGE_BYTES))
    found = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0]
    return sorted(set(found or []))


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Ranges from 0, descending by id: the number of cuts above it; rows without id are in the last range."""
    step = max(1, math.isqrt(len(cuts)))
    chunks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    tops = F.from_json(F.lit(json.dumps([c[0] for c in chunks])), "array<long>")
    inner = F.from_json(F.lit(json.dumps(chunks)), "array<array<long>>")
    at = F.size(F.filter(tops, lambda c: c <= doc_id))
    within = F.size(F.filter(F.try_element_at(inner, at), lambda c: c <= doc_id))
    not_above = F.when(at == 0, F.lit(0)).otherwise((at - 1) * step + within)
    return F.when(doc_id.isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - not_above)


def with_followers(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """range, place, guest, doc_id, text, next: the text of the next row by descending id (after the last: the first).

    Rows of one id are in the order of their texts, rows without id come last.
    Ids are cut into ranges, and place is the position in the range. The first
    row of each range is also sent, as a guest, to the range before it, and the
    first row of all to the last range, so that no order over all rows is made.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.withColumn("range", _range_of(F.col("doc_id"), _cut_points(rows)))
    # a head for each range, of ids alone
    heads = sorted((r.range, r.head) for r in ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect())
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    sent = spark.createDataFrame(before, "head long, to int")
    home = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    away = F.struct(F.col("to").alias("range"), F.lit(True).alias("guest"))
    dealt = (
        ranged.join(F.broadcast(sent), F.col("doc_id").eqNullSafe(F.col("head")), "left")
        .select("doc_id", "text", F.explode(F.when(F.col("to").isNull(), F.array(home)).otherwise(F.array(home, away))).alias("to"))
        .select("doc_id", "text", "to.*")
    )
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))


def edited(text: Column, following: Column) -> Column:
    """text, its last half replaced by the first as many characters (or all) of the following text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def likeness(one: Column, other: Column) -> Column:
    """Share of parts on which two fingerprints agree, of those where either has a term; 1 if neither has any."""
    digits = lambda f: F.regexp_extract_all(f, F.lit("." * _DIGITS), F.lit(0))
    # null where neither has a term
    agree = F.zip_with(digits(one), digits(other), lambda a, b: F.when((a != _EMPTY) | (b != _EMPTY), a == b))
    used, same = F.size(F.array_compact(agree)), F.size(F.filter(agree, lambda x: x))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def _in_draw() -> Column:
    """Whether the term is in the draw: a draw of z zero bits takes one term of 2**z."""
    wanted = F.element_at(F.array(*[F.lit(1 << z) for z in DRAWS]), F.col("draw") + 1)
    return F.pmod(F.xxhash64("term", F.lit("draw")), wanted) == 0


def fingerprints(spark: SparkSession, docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of docs.

    The edited text is the text with its last half replaced by the first as
    many characters of the following text (with_followers). Null texts count as
    empty; a text without terms has a fingerprint of zeros, and two such are
    alike. Texts without lexicon terms are alike if their sets of terms are
    equal. Equal texts have equal fingerprints, whatever their rows.
    No rows give no rows.
    """
    scratch = Scratch(spark, "lexicon")
    terms = scratch.keep(lexicon(docs, scratch, band))
    rows = with_followers(spark, docs).withColumn("edited", F.when(~F.col("guest"), edited(F.col("text"), F.col("next"))))
    by = ["range", "place", "version"]
    versions = F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("body"))))
    words = rows.select("range", "place", versions.alias("v")).select("range", "place", "v.*").where("body IS NOT NULL")
    listed_terms = words.select(*by, _terms(F.col("body")).alias("terms")).where(F.size("terms") > 0)
    # beside its terms, each text has a row with the hash of them all
    whole = F.xxhash64(F.sort_array("terms"))
    no = F.lit(None).cast("long")
    each = F.concat(F.transform("terms", lambda t: F.struct(t.alias("term"), no.alias("whole"))), F.array(F.struct(no.alias("term"), whole.alias("whole"))))
    exploded = listed_terms.select(*by, F.inline(each))
    met = exploded.join(F.broadcast(terms.withColumnRenamed("term", "known")), F.col("term") == F.col("known"), "left").where("known IS NOT NULL OR whole IS NOT NULL")
    draw = F.explode(F.array(*[F.lit(i) for i in range(len(DRAWS))])).alias("draw")
    drawn = met.select(*by, "term", "whole", draw).where(F.when(F.col("whole").isNull(), _in_draw()).otherwise(F.col("draw") == 0))
    part = (F.pmod(F.xxhash64("term", "draw"), F.lit(PARTS)) + F.col("draw") * PARTS).cast("int")
    part = F.when(F.col("whole").isNull(), part).otherwise(-1)
    # The groupings keep to the range that the rows are dealt by, so they need no shuffle. The terms of a text are
    # distinct, and the hash of a part is the exclusive or of theirs: it needs no order to be the same for equal sets.
    hashed = drawn.groupBy(*by, part.alias("part")).agg(
        F.bit_xor(F.coalesce("whole", F.xxhash64("term", "draw", F.lit("part")))).alias("hash")
    )
    digits = lambda h: F.lpad(F.hex(F.pmod(h, F.lit(16**_DIGITS - 1)) + 1), _DIGITS, "0")
    listed = hashed.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("part") >= 0, F.struct("part", digits(F.col("hash")).alias("digits"))))).alias("parts"),
        F.max(F.when(F.col("part") < 0, F.col("hash"))).alias("whole"),
        F.max("part").alias("last"),
    )
    every = F.sequence(F.lit(0), F.lit(PARTS * len(DRAWS) - 1))
    # a part is a hash of its terms, or of all terms if none is in the lexicon
    told = F.transform(every, lambda p: F.coalesce(F.try_element_at("parts", p), F.lit(_EMPTY)))
    alone = F.transform(every, lambda p: digits(F.xxhash64("whole", p)))
    printed = F.array_join(F.when(F.col("last") >= 0, told).otherwise(alone), "")
    prints = listed.groupBy(F.col("range").alias("of_range"), F.col("place").alias("of_place")).agg(
        F.max(F.when(F.col("version") == 0, printed)).alias("own"), F.max(F.when(F.col("version") == 1, printed)).alias("other")
    )
    none = F.lit(_EMPTY * (PARTS * len(DRAWS)))
    # what is joined and ordered from here on is narrow
    narrow = rows.select("range", "place", "guest", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    # a plain equality would put a filter for nulls below the texts' shuffle on one side, and the texts would be shuffled twice
    same = F.col("range").eqNullSafe(F.col("of_range")) & F.col("place").eqNullSafe(F.col("of_place"))
    whole = narrow.join(prints, same, "left").withColumn("fingerprint", F.coalesce("own", none)).withColumn("edited_fingerprint", F.coalesce("other", none))
    following = F.lead("fingerprint").over(Window.partitionBy("range").orderBy("place"))
    return whole.withColumn("next_fingerprint", following).where("NOT guest").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
