"""Near-duplicate documents: universal hash minima, bands, verification, components.

1. A map over the texts gives each document the size and a digest of its set of
   word shingles and its signature, the minima of many universal hash functions.
   Documents with equal sets form a class; only its smallest id goes on.
2. Bands of the signature are bucket keys. In each bucket the members are
   compared with one pivot, the member with the largest buckets, which in a
   family of near copies is the text that the others vary: signatures first,
   then the full shingle sets. Members that are far from the pivot form the
   bucket again, without it, and get another pivot. Buckets of a few members are
   compared whole. What has no pivot after some rounds is dealt into narrower
   buckets, by the shingles of each text that are rarest among such texts: a pair
   at similarity t shares one of its n - ceil(t n) + 1 rarest ones (a prefix
   filter). So no large bucket is ever compared whole, and no pair is lost.
3. Two members that are not linked to their pivot, or one that is not and one
   that is, can still be linked with each other, where no later round compares
   them. Families whose pivots are of one component are one family. Its members are
   described by their deviations from the shingles that most of it hold: shingles
   that they have and the majority lacks (added), or the other way round (removed).
   With w = t |added| + |removed|, a pair with w1 + w2 <= (1 - t) |majority| is
   linked. All members that are so with any other are so with the one of least w,
   and linked with it. Every other pair at similarity t or more has at least
   (w1 + w2 - (1 - t) |majority|) / (1 + t) deviations in common, so one of the
   rarest deviations of either is common (a prefix filter), and only pairs that
   meet there are compared. A family of near copies whose edits differ costs
   rows in proportion to its edits, not to its pairs.
4. Linked documents are joined to components.

Joins of tables that are both shuffled by the same key are merge joins on small inputs
too: to broadcast a side after its shuffle would cost the driver memory in each of many steps.

Two linked texts miss each other in all buckets with probability MISS at most.
Pairs that meet are decided on their full sets.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import LongType

from .components import components
from .scratch import Scratch
from .words import BY_SPACE, mixed, runs, sliced

ROWS = 4  # minima in a band
MISS = 1e-6  # chance that a pair at the threshold shares no band
FEW = 8  # members of a bucket that are compared with each other
SLOT_BITS = 20  # of the number of counters that estimate the frequencies of shingles
PIVOTS = 2  # pivots of a bucket before what is far from all of them is dealt into narrower ones
#: Ids of texts that share a bucket are sent to all tasks up to this number.
BROADCAST_IDS = 1_000_000
_SEED = 7919


def bands_for(percent: int) -> int:
    """Bands with which a pair at the threshold is missed with probability MISS at most."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """a (odd) and b of n universal hash functions, the upper half of a * x + b modulo 2**64."""
    rng = np.random.Generator(np.random.PCG64(_SEED))
    return rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, dtype=np.uint64)


def _shingle_sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of a batch, and of each of their rows the sorted hashes of its distinct shingles."""
    for rows, words in sliced(batch, "text", BY_SPACE):
        hashes = words.hashes(fold=True)
        shingles = runs(hashes, width)
        sets = []
        for lo, hi in zip(words.first[:-1], words.first[1:]):
            if hi - lo >= width:
                sets.append(np.unique(shingles[lo : hi - width + 1]))
            elif hi > lo:
                sets.append(mixed(runs(hashes[lo:hi], hi - lo) + np.uint64(hi - lo)))
            else:
                sets.append(np.empty(0, dtype=np.uint64))
        yield rows, sets


def _signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), (1 << 64) - 1, dtype=np.uint64)
    for lo in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[lo : lo + 1024, None] * a + b).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketches(docs: DataFrame, width: int, bands: int) -> DataFrame:
    def sketch(batches):
        a, b = _functions(ROWS * bands)
        for batch in batches:
            for rows, sets in _shingle_sets(batch, width):
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([_signature(s, a, b).tobytes() for s in sets], pa.binary()),
                    ],
                    ["id", "n_shingles", "digest", "signature"],
                )

    return docs.mapInArrow(sketch, "id long, n_shingles long, digest binary, signature binary")


def _buckets(leaders: DataFrame, bands: int) -> DataFrame:
    """(key, id) of every band of every class."""

    def explode(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            minima = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(len(ids), bands, ROWS)
            keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(ids), bands))
            for row in range(ROWS):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, row])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, bands))], ["key", "id"])

    return leaders.select("id", "signature").mapInArrow(explode, "key long, id long")


@F.pandas_udf(LongType())
def _equal_minima(one: pd.Series, other: pd.Series) -> pd.Series:
    def minima(column: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(len(column), -1)

    return pd.Series((minima(one) == minima(other)).sum(axis=1) if len(one) else [], dtype="int64")


#: Estimated similarities from which on a member belongs to its pivot's family, and needs no other pivot. Two linked
#: texts are about as similar to a pivot, so either both are of its family or both get another one; and a pivot that
#: is far from them is in a few of the many buckets only that they share.
FAMILY, SETTLED = 0.2, 0.5


def _compared(pairs: DataFrame, leaders: DataFrame, sets: DataFrame, bands: int, least: float) -> DataFrame:
    """(a, b, share, common, n_a, n_b): pairs of classes with their estimated similarity, and from least on the exact one.

    common is the size of the intersection of the full sets, null below least.
    """
    signatures = leaders.select("id", "signature")
    likely = (
        pairs.join(signatures.toDF("a", "s_a").hint("merge"), "a").join(signatures.toDF("b", "s_b"), "b")
        .select("a", "b", "star", (_equal_minima("s_a", "s_b") / F.lit(ROWS * bands)).alias("share"))
    )
    near = F.col("share") >= least
    # far pairs stay, without their sets
    wanted = F.when(near, F.col("a"))
    with_a = likely.withColumn("k", wanted).join(sets.toDF("k", "x_a"), "k", "left").drop("k")
    with_b = with_a.withColumn("k", F.when(near, F.col("b"))).join(sets.toDF("k", "x_b"), "k", "left").drop("k")
    common = F.when(near, F.size(F.array_intersect("x_a", "x_b")))
    return with_b.select("a", "b", "star", "share", common.alias("common"), F.size("x_a").alias("n_a"), F.size("x_b").alias("n_b"))


def _slots(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The counter of each shingle: its upper bits, for shingles are hashes."""
    return (shingles.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _frequencies(wanted: DataFrame, bits: int) -> np.ndarray:
    """How many of the sets hold a shingle of each counter, 65,535 standing for more: never less than hold one shingle.

    Each task counts its own sets; a row is a block of counters, whatever the sets hold.
    """
    counters, block = 1 << bits, 1 << min(bits, 12)

    def count(batches):
        counts = np.zeros(counters, dtype=np.uint32)
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                counts += np.bincount(_slots(batch.column(0).slice(lo, 1024).flatten().to_numpy(), bits), minlength=counters).astype(np.uint32)
        places = [at for at in range(0, counters, block) if counts[at : at + block].any()]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array([counts[at : at + block].tobytes() for at in places], pa.binary())], ["at", "counts"])

    def total(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(block, dtype=np.int64)
        for part in parts["counts"]:
            counts += np.frombuffer(part, dtype=np.uint32)
        return pd.DataFrame({"at": [key[0]], "counts": [np.minimum(counts, 65_535).astype(np.uint16).tobytes()]})

    parts = wanted.select("shingles").mapInArrow(count, "at long, counts binary")
    frequency = np.zeros(counters, dtype=np.uint16)
    for at, counts in parts.groupBy("at").applyInPandas(total, "at long, counts binary").collect():
        frequency[at : at + block] = np.frombuffer(counts, dtype=np.uint16)
    return frequency


def _rarest(wanted: DataFrame, percent: int, bits: int = SLOT_BITS) -> DataFrame:
    """(id, tokens): of each set the rarest shingles, of which a linked set has one among its own rarest ones.

    Any order of all shingles would do; that by estimated frequency keeps what many
    sets hold for the last. Shingles of one set only meet nothing and are left out.
    """
    estimated = wanted.sparkSession.sparkContext.broadcast(_frequencies(wanted, bits))

    def rarest(batches):
        frequency = estimated.value
        for batch in batches:
            found = []
            for lo in range(len(batch)):
                shingles = batch.column(1).slice(lo, 1).flatten().to_numpy()
                held = frequency[_slots(shingles, bits)]
                first = np.lexsort((shingles, held))[: len(shingles) * (100 - percent) // 100 + 1]
                found.append(shingles[first[held[first] > 1]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "tokens"])

    return wanted.select("id", "shingles").mapInArrow(rarest, "id long, tokens array<long>")


def _narrowed(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, id, fame) again, a bucket being the members of one of rest that share one of their rarest shingles."""
    wanted = sets.join(rest.select("id").distinct().hint("merge"), "id", "left_semi")
    # rows of one id with different texts have a set each
    rare = _rarest(wanted, percent).select("id", F.explode("tokens").alias("token")).distinct()
    shared = rare.groupBy("token").agg(F.count("*").alias("f")).where("f > 1").select("token")
    rare = rare.join(shared.hint("merge"), "token")
    return rest.join(rare.hint("merge"), "id").select(F.xxhash64("key", "token").alias("key"), "id", "fame")


def _is_linked(percent: int):
    return F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent


def _against_majority(sized: DataFrame) -> DataFrame:
    """The same deviations, taken against the shingles that most of a family hold instead of those of its pivot.

    sized has (f, ..., n, added, removed), n being the size of the set that they
    deviate from. What the pivot alone has or lacks is a deviation of all others,
    which all of them would share; against the majority it is nobody's but the
    pivot's, and no deviation is shared by more than half of a family.
    """
    signed = sized.select("f", F.inline(F.concat(*[F.transform(c, lambda t, s=s: F.struct(t.alias("token"), F.lit(s).alias("sign"))) for c, s in (("added", 1), ("removed", -1))])))
    size = sized.groupBy("f").agg(F.count("*").alias("members"))
    common = signed.groupBy("f", "token", "sign").agg(F.count("*").alias("held")).join(size, "f").where("2 * held > members")
    none = F.array().cast("array<long>")
    turned = common.groupBy("f").agg(*[F.collect_list(F.when(F.col("sign") == s, F.col("token"))).alias(c) for c, s in (("more", 1), ("less", -1))])
    met = sized.join(turned, "f", "left").withColumns({c: F.coalesce(c, none) for c in ("more", "less")})
    added = F.concat(F.array_except("added", "more"), F.array_except("less", "removed"))
    removed = F.concat(F.array_except("removed", "less"), F.array_except("more", "added"))
    return met.withColumns({"n": F.col("n") + F.size("more") - F.size("less"), "added": added, "removed": removed}).drop("more", "less")


def _families(stars: DataFrame, percent: int) -> DataFrame:
    """(p, id, gone) of the comparisons with pivots: members of which a pair may be linked that no later round compares.

    gone is a member that no round compares again. Two that are not gone meet
    again in their bucket, so a member that is not is wanted for those that are. Jaccard
    distance is a metric: linked texts are equally similar to a pivot but for
    1 - t, so it must come near enough to the least similar of them.
    """
    like = F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
    # an id has several rows here if it has several texts
    each = stars.groupBy(F.col("b").alias("p"), F.col("a").alias("id")).agg(
        (F.min("share") >= SETTLED).alias("gone"), F.min(like).alias("least"), F.max(like).alias("most")
    ).where("most IS NOT NULL")
    least = each.where("gone").groupBy("p").agg(F.min("least").alias("bound"))
    reach = F.col("most") + (100 - percent) / 100 + 1e-9
    return each.join(least, "p").where(F.col("gone") | (reach >= F.col("bound"))).select("p", "id", "gone")


def _deviating_pairs(family: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): members of one family in different components that share enough deviations to be linked.

    family has (p, id, gone), see _families. Families of pivots of one component are one,
    so that a member of many of them is compared once.
    """
    whole = family.join(labels.toDF("p", "f"), "p", "left").withColumn("f", F.coalesce("f", "p"))
    # the pivot that most members met stands for the others
    pivot = whole.groupBy("f", "p").agg(F.count("*").alias("n")).groupBy("f").agg(F.max_by("p", F.struct("n", -F.col("p"))).alias("p"))
    member = whole.groupBy("f", "id").agg(F.max("gone").alias("gone")).join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    member = scratch.keep(member)
    open_ = member.groupBy("f").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("f")
    reference = sets.toDF("p", "x").join(pivot.join(open_, "f"), "p").groupBy("f").agg(F.min("x").alias("pivot"))
    known = member.join(sets.toDF("id", "x").hint("merge"), "id").join(reference, "f")
    # rows of one id with different texts have a set each
    sized = known.select("f", "id", F.xxhash64("x").alias("set"), "gone", "component", F.size("pivot").alias("n"), F.array_except("x", "pivot").alias("added"), F.array_except("pivot", "x").alias("removed"))
    by_pivot = scratch.keep(sized)
    sized = _against_majority(by_pivot)
    # w and the room (1 - t) n in hundredths, so that all bounds are whole numbers
    w, room = F.size("added") * percent + F.size("removed") * 100, F.col("n") * (100 - percent)
    sized = scratch.keep(sized.withColumns({"d": F.size("added") + F.size("removed"), "w": w, "room": room}))
    scratch.drop(member, by_pivot)
    # Texts with w1 + w2 <= room are linked whatever they share. All that are so with any are
    # so with the member of least w; these pairs stand for them, and make them one component.
    centre = sized.groupBy("f").agg(F.min(F.struct("w", "id", "component")).alias("c")).select("f", F.col("c.w").alias("w0"), F.col("c.id").alias("centre"), F.col("c.component").alias("main"))
    members = sized.drop("n", "added", "removed").join(centre, "f").withColumn("core", F.col("w") + F.col("w0") <= F.col("room"))
    near = members.where("core AND component <> main").select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b"))
    rows = sized.select("f", "id", "set", F.explode(F.concat("added", "removed")).alias("token"))
    frequency = rows.groupBy("f", "token").agg(F.count("*").alias("held"))
    rank = F.row_number().over(Window.partitionBy("f", "id", "set").orderBy("held", "token")) - 1
    # a token of one member only has a rank, but meets nothing
    ranked = rows.join(frequency.hint("merge"), ["f", "token"]).withColumn("rank", rank).where("held > 1")
    ranked = ranked.join(members.withColumn("main", F.expr("core OR component = main")).hint("merge"), ["f", "id", "set"])
    # at least so many deviations in common, whatever the other text is: one of both is not of the core
    unlinked = ranked.where("NOT main").where(F.col("rank") <= F.col("d") - F.greatest(F.lit(1), F.ceil((F.col("w") - F.col("room")) / 100)))
    every = ranked.where(F.col("rank") <= F.col("d") - F.greatest(F.lit(1), F.ceil((F.col("w") - F.col("w0") + 1) / (100 + percent))))
    met = unlinked.alias("x").join(
        every.hint("merge").alias("y"),
        F.expr(
            "x.f = y.f AND x.token = y.token AND x.component <> y.component AND (x.gone OR y.gone) AND (y.main OR x.id > y.id)"
            f" AND greatest(x.rank - x.d, y.rank - y.d) <= -ceil((x.w + y.w - x.room) / {100 + percent})"
        ),
    )
    return met.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).unionAll(near).distinct()


def _full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    def sets(batches):
        for batch in batches:
            for rows, found in _shingle_sets(batch, width):
                own = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([rows.column(0), own], ["id", "shingles"])

    # ids travel to the texts while there are few; the texts are shuffled beyond
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(wanted, docs.doc_id == ids.id, "left_semi").mapInArrow(sets, "id long, shingles array<long>")


def _labelled(sketches: DataFrame, classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The result for every row of sketches; without labels every class is a component."""
    whole = sketches.join(classes, "digest", "left")
    if labels is None:
        whole = whole.withColumn("component", F.col("leader"))
    else:
        whole = whole.join(labels.withColumnRenamed("id", "leader"), "leader", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "leader")).otherwise(F.col("id"))
    return whole.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked at a Jaccard similarity of percent / 100 or more.

    docs needs doc_id and text; other columns are not read. Words are split at
    ASCII white space and A-Z is lower-cased. A text of fewer than width words
    is one shingle; a null, empty or blank text has none, and no links. Rows of
    one doc_id with different texts are judged one by one, and the links of
    either count for the id. A row without doc_id is linked with nothing: its
    component_id is null and it is kept. No rows give no rows.
    """
    scratch = Scratch(spark, "minhash")
    bands = bands_for(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = scratch.keep(_sketches(docs, width, bands))
    # equal sets have equal signatures, so copies collapse in each task
    leaders = scratch.keep(
        sketches.where("n_shingles > 0 AND id IS NOT NULL").groupBy("digest")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    classes = leaders.select("digest", F.col("id").alias("leader"))
    every = _buckets(leaders, bands)
    sizes = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = scratch.keep(every.join(sizes.hint("merge"), "key"))
    fame = buckets.groupBy("id").agg(F.sum("n").alias("fame"))
    size = {"n": F.count(F.lit(1))}
    rest, left = scratch.measured(buckets.select("key", "id").join(fame.hint("merge"), "id"), **size)
    scratch.drop(buckets)
    sets = scratch.keep(_full_sets(docs, rest.select("id").distinct(), width).dropDuplicates(["id", "shingles"]))
    found = []
    while left["n"]:
        best = rest.groupBy("key").agg(F.max(F.struct("fame", (-F.col("id")).alias("id"))).alias("top"), F.count("*").alias("n"))
        best = best.where("n > 1").select("key", (-F.col("top.id")).alias("p"), "n")
        met = scratch.keep(rest.join(best.hint("merge"), "key"))
        # a few members are compared with each other, more with their pivot
        few, many = met.where(F.col("n") <= FEW), met.where((F.col("n") > FEW) & (F.col("id") != F.col("p")))
        direct = few.alias("x").join(few.hint("merge").alias("y"), F.expr("x.key = y.key AND x.id > y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.lit(False).alias("star"))
        star = many.select(F.col("id").alias("a"), F.col("p").alias("b"), F.lit(True).alias("star"))
        pairs = direct.unionAll(star).groupBy("a", "b").agg(F.max("star").alias("star"))
        compared = scratch.keep(_compared(pairs, leaders, sets, bands, FAMILY))
        found.append(compared)
        far = compared.where(F.col("star") & (F.col("share") < SETTLED)).select(F.col("a").alias("id"), F.col("b").alias("p"))
        before = rest
        rest, left = scratch.measured(many.join(far.hint("merge"), ["id", "p"]).select("key", "id", "fame"), **size)
        scratch.drop(before, met)
        if len(found) == PIVOTS and left["n"]:
            before = rest
            rest, left = scratch.measured(_narrowed(before, sets, percent), **size)
            scratch.drop(before)
    if not found:
        return _labelled(sketches, classes, None)
    compared = functools.reduce(DataFrame.unionAll, found)
    edges = compared.where(_is_linked(percent)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    labels = scratch.keep(components(edges, scratch))
    more, met = scratch.measured(_deviating_pairs(_families(compared.where("star"), percent), sets, labels, percent, scratch), **size)
    if met["n"]:
        late = _compared(more.withColumn("star", F.lit(False)), leaders, sets, bands, 0.0).where(_is_linked(percent)).select("a", "b")
        labels = scratch.keep(components(edges.unionAll(late), scratch))
    scratch.drop(sets)
    return _labelled(sketches, classes, labels)
