"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source should be taken target / source size times. The whole
part is sure; the fraction is rounded so that words, not documents, are kept:
two fractional documents meet, words move from one to the other in a random
direction until one fraction is 0 or 1, and the other goes on. Each block of a
source leaves one fractional document at most; these meet again in blocks of
blocks until one is left, which a coin of its own fraction decides. So the
words taken of a source differ from its target by less than one document.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

BLOCK = 2_000
WEIGHTS = (5, 2, 1)
CAP = 3
_EPS = 1e-9
_DECIDED = "source string, id long, size long, rows long, copies long, p double, block long"


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> dict[str | None, float]:
    """The target of each source: total shared by weight, no source above cap times its size.

    Sources are in code point order, null last, and take the weights in turn.
    What a capped source can't take is shared again by weight.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, total = dict(order), float(sum(n for _, n in order))
    out: dict[str | None, float] = {}
    free = [s for s, n in order if n]
    out.update({s: 0.0 for s, n in order if not n})
    while free:
        left = total - math.fsum(out.values())
        weighed = sum(weight[s] for s in free)
        share = {s: left * weight[s] / weighed for s in free}
        above = [s for s in free if share[s] >= cap * size[s]]
        out.update({s: float(cap * size[s]) for s in above} if above else share)
        free = [s for s in free if s not in out] if above else []
    return out


def _meet(rows: Iterator[tuple[int, int, float]], seed: str) -> tuple[dict[int, int], tuple[int, float] | None]:
    """Rows (position, size, fraction) meet in turn: what each rounds to, and the one left with its fraction."""
    coin = random.Random(int.from_bytes(hashlib.blake2b(seed.encode(), digest_size=8).digest(), "big"))
    done: dict[int, int] = {}
    left: tuple[int, int, float] | None = None
    for at, size, p in rows:
        if p <= _EPS or p >= 1 - _EPS:
            done[at] = int(p >= 0.5)
            continue
        if left is None:
            left = (at, size, p)
            continue
        other, other_size, q = left
        # words that can move to this document, and to the other one
        here, there = min((1 - p) * size, q * other_size), min(p * size, (1 - q) * other_size)
        move = here if coin.random() * (here + there) < there else -there
        p, q = p + move / size, q - move / other_size
        left = None
        for place, words, share in ((at, size, p), (other, other_size, q)):
            if share <= _EPS or share >= 1 - _EPS:
                done[place] = int(share >= 0.5)
            else:
                left = (place, words, share)
    return done, left and (left[0], left[2])


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    # the largest meet first: what is left at the end, and may miss the target, is then a small one
    pdf = pdf.sort_values(["size", "order", "id", "rows"], ascending=[False, True, True, True], ignore_index=True, na_position="last")
    seed = f"{pdf['source'].iloc[0]!r} {pdf['level'].iloc[0]} {pdf['block'].iloc[0]}"
    done, left = _meet(zip(range(len(pdf)), pdf["size"].tolist(), pdf["p"].tolist()), seed)
    rounded = pd.Series([done.get(i, 0) for i in range(len(pdf))], index=pdf.index)
    out = pdf.assign(copies=pdf["copies"] + rounded, p=0.0, block=-1)
    if left:
        out.loc[left[0], "p"] = left[1]
        out.loc[left[0], "block"] = pdf["block"].iloc[0]
    return out[["source", "id", "size", "rows", "copies", "p", "block"]]


def word_count(text: str = "text"):
    """Words of a text column; null has none."""
    # a word starts where a word character follows a separator or the start
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """row (all columns of docs as a struct), doc_id, size, source_size, target, copies, taken.

    A document's size is its number of words (null: none). Rows that agree in
    doc_id, source and size are one document: they are taken equally often, and
    its size is theirs together. A document without words is never taken. The
    result depends on the rows alone, not on their order or partitions. The
    number of sources must fit the driver; no rows give no rows.
    """
    scratch = Scratch(spark, "mix")
    sized = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), "source", word_count().alias("size"))
    same = scratch.keep(sized.groupBy("source", "id", "size").agg(F.count("*").alias("rows")))
    counts = same.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("words"), F.count("*").alias("n")).collect()
    wanted = targets([(r.source, r.words) for r in counts], weights, cap)
    plan = spark.createDataFrame(
        [(r.source, r.words, wanted[r.source], wanted[r.source] / r.words if r.words else 0.0, max(1, math.ceil(r.n / BLOCK))) for r in counts],
        "source string, source_size long, target double, ratio double, blocks long",
    )
    planned = F.broadcast(plan.withColumnRenamed("source", "s"))
    order = F.xxhash64("id", "size", F.lit("mix"))
    # a ratio of a whole number, but for rounding, has no fraction
    whole = F.floor(F.col("ratio") + _EPS)
    level = 0
    rows = (
        same.join(planned, F.col("source").eqNullSafe(F.col("s")))
        .where("size > 0")
        .select(
            "source", "id", F.expr("size * rows").alias("size"), "rows", whole.alias("copies"),
            F.greatest(F.col("ratio") - whole, F.lit(0.0)).alias("p"), F.pmod(order, "blocks").alias("block"), F.lit(0).alias("level"), order.alias("order"),
        )
    )
    settled, blocks = [], max([1, *(math.ceil(r.n / BLOCK) for r in counts)])
    while True:
        decided = scratch.keep(rows.groupBy("source", "block").applyInPandas(_round, _DECIDED))
        settled.append(decided.where("block < 0"))
        if blocks == 1:
            break
        level, blocks = level + 1, math.ceil(blocks / BLOCK)
        rows = decided.where("block >= 0").select(
            "source", "id", "size", "rows", "copies", "p", F.floor(F.col("block") / BLOCK).alias("block"), F.lit(level).alias("level"), F.col("block").alias("order")
        )
    # one document of each source may be left: a coin of its fraction
    coin = F.pmod(F.xxhash64("id", "size", F.lit("last")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    settled.append(decided.where("block >= 0").withColumn("copies", F.col("copies") + (coin < F.col("p")).cast("long")))
    taken = settled[0]
    for more in settled[1:]:
        taken = taken.unionAll(more)
    taken = taken.select(F.col("source").alias("t_source"), F.col("id").alias("t_id"), F.col("size").alias("t_size"), F.col("rows").alias("t_rows"), "copies")
    again = same.select(F.col("source").alias("a_source"), F.col("id").alias("a_id"), F.col("size").alias("a_size"), "rows")
    by_document = again.join(
        taken,
        F.col("a_source").eqNullSafe(F.col("t_source")) & F.col("a_id").eqNullSafe(F.col("t_id")) & (F.col("rows") == F.col("t_rows"))
        & (F.col("a_size") * F.col("rows") == F.col("t_size")),
        "left",
    ).select("a_source", "a_id", "a_size", F.coalesce("copies", F.lit(0)).alias("copies"))
    return (
        sized.join(by_document, F.col("id").eqNullSafe(F.col("a_id")) & F.col("source").eqNullSafe(F.col("a_source")) & (F.col("size") == F.col("a_size")))
        .join(planned, F.col("source").eqNullSafe(F.col("s")))
        .select("row", F.col("id").alias("doc_id"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )
