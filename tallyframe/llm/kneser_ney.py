"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

Runs of up to ORDER characters of trusted texts are counted. A run is one long,
16 bits a character, so that its context (all but the last character) and its
suffix (all but the first) are shifts and masks, and continuation counts,
contexts and probabilities are groupings and joins of Spark tables. For
scoring, documents are dealt into groups by their id and packed. A group asks
once for each of its distinct runs; requests meet the model in a join on the
run, and the answers go back to the group, where every document adds up its
characters. Characters beyond the basic plane share 16 bits with others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .groups import number_of_groups, packed, unpacked
from .scratch import Scratch
from .words import slices

ORDER = 4
#: Trusted ids are sent to all tasks up to this number, and joined by shuffle beyond.
BROADCAST_IDS = 4_000_000
#: Share of a language's trusted, held-out documents that its threshold keeps.
QUANTILE = 0.98
_BINS = 1000  # of a bit
_EDGE = 10  # texts begin after line ends


def run_keys(text: str | None) -> np.ndarray:
    """The run of ORDER characters that ends at each character of the text, 16 bits a character."""
    body = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    codes = np.concatenate((np.full(ORDER - 1, _EDGE, dtype=np.uint64), (body ^ (body >> np.uint64(16))) & np.uint64(0xFFFF)))
    out = np.zeros(len(body), dtype=np.uint64)
    for j in range(ORDER):
        out = out << np.uint64(16) | codes[j : j + len(body)]
    return out


def _suffix(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & np.uint64((1 << 16 * n) - 1)


def _count(batches):
    for batch in batches:
        for lo, hi in slices(batch.column(0), 8 << 20):
            found = [run_keys(t) for t in batch.column(0).slice(lo, hi - lo).to_pylist()]
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of runs met once, twice, and more often."""
    n1, n2, n3, n4 = (counts.agg(*(F.count_if(F.col("n") == k) for k in (1, 2, 3, 4))).first())
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = [k - (k + 1) * y * after / own if own else 0.0 for k, own, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(out, 1))


def fit(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, float]:
    """The model of texts (text): (level, key, p, gamma) and the probability of a character never seen.

    p is the probability of the run's last character after the others; gamma
    what its followers leave to shorter runs, if it is a context.
    """
    counts = {ORDER: scratch.keep(texts.select("text").mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))}
    for level in range(ORDER - 1, 0, -1):
        longer = counts[level + 1]
        counts[level] = scratch.keep(longer.groupBy(F.col("key").bitwiseAND((1 << 16 * level) - 1).alias("key")).agg(F.count("*").alias("n")))
    seen = counts[1].count()
    lower, rest = None, 1.0 / (seen + 1)
    parts = []
    for level in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[level])
        n = F.col("n")
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        rows = counts[level].withColumn("context", F.shiftrightunsigned("key", 16) if level > 1 else F.lit(0).cast("long"))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("left")).select("context", "total", (F.col("left") / F.col("total")).alias("gamma"))
        if level == 1:
            first = contexts.first()
            rest = (first.gamma if first else 1.0) / (seen + 1)
            own = rows.join(contexts, "context").select("key", ((n - discount) / F.col("total") + rest).alias("p"))
        else:
            below = lower.select(F.col("key").alias("suffix"), F.col("p").alias("q"))
            own = (
                rows.join(contexts, "context").withColumn("suffix", F.col("key").bitwiseAND((1 << 16 * (level - 1)) - 1)).join(below, "suffix")
                .select("key", ((n - discount) / F.col("total") + F.col("gamma") * F.col("q")).alias("p"))
            )
            parts.append(contexts.select(F.lit(level - 1).alias("level"), F.col("context").alias("key"), F.lit(None).cast("double").alias("p"), "gamma"))
        lower = scratch.keep(own)
        parts.append(lower.select(F.lit(level).alias("level"), "key", "p", F.lit(None).cast("double").alias("gamma")))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionAll(part)
    return scratch.keep(table.groupBy("level", "key").agg(F.max("p").alias("p"), F.max("gamma").alias("gamma"))), rest


def _ask(pdf: pd.DataFrame) -> pd.DataFrame:
    """The distinct runs of every length of a group's texts."""
    keys = np.empty(0, dtype=np.uint64)
    for batch in unpacked(pdf["docs"]):
        for lo, hi in slices(batch.column(2), 4 << 20):
            keys = np.unique(np.concatenate([keys, *(run_keys(t) for t in batch.column(2).slice(lo, hi - lo).to_pylist())]))
    # a context is the run that ends one character earlier; that before the first character is of line ends only
    edge = np.uint64(int.from_bytes(_EDGE.to_bytes(2, "big") * (ORDER - 1), "big"))
    levels = [np.unique(np.append(_suffix(keys, n), _suffix(edge, n))) for n in range(1, ORDER)] + [keys]
    return pd.DataFrame({
        "group": pdf["group"].iloc[0],
        "level": np.repeat(np.arange(1, ORDER + 1), [len(x) for x in levels]),
        "key": np.concatenate(levels).view(np.int64),
    })


def _bits(texts: list[str | None], known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], rest: float) -> np.ndarray:
    """Bits a character of each text; not a number if it has none."""

    def of(level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        have, p, gamma = known[level]
        if not len(have):
            return np.full(len(keys), np.nan), np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        hit = have[at] == keys
        return np.where(hit, p[at], np.nan), np.where(hit, gamma[at], np.nan)

    runs_of = [run_keys(t) for t in texts]
    keys, at = np.unique(np.concatenate(runs_of), return_inverse=True)
    value = np.full(len(keys), rest)
    for level in range(1, ORDER + 1):
        p, _ = of(level, _suffix(keys, level))
        if level > 1:
            context = _suffix(keys, level) >> np.uint64(16)
            gamma = of(level - 1, context)[1]
            value = value * np.where(np.isnan(gamma), 1.0, gamma)
        value = np.where(np.isnan(p), value, p)
    each = -np.log2(np.maximum(value, 1e-300))[at]
    sizes = np.array([len(r) for r in runs_of])
    sums = np.diff(np.concatenate(([0.0], np.cumsum(each)))[np.concatenate(([0], np.cumsum(sizes)))])
    return np.where(sizes > 0, sums / np.maximum(sizes, 1), np.nan)


def scored(spark: SparkSession, docs: DataFrame, model: DataFrame, rest: float) -> DataFrame:
    """doc_id, lang, n_chars, bits (a character; null if there is none) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    dealt = packed(docs, number_of_groups(docs), ["doc_id", "lang", "text"])
    answers = (
        dealt.groupBy("group").applyInPandas(_ask, "group long, level int, key long")
        .join(model, ["level", "key"])
    )

    def add_up(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known = {}
        for level in range(1, ORDER + 1):
            own = told[told["level"] == level]
            keys = own["key"].to_numpy().astype(np.int64).view(np.uint64)
            order = np.argsort(keys)
            known[level] = keys[order], own["p"].to_numpy(dtype=float)[order], own["gamma"].to_numpy(dtype=float)[order]
        out = []
        for batch in unpacked(pdf["docs"]):
            for lo, hi in slices(batch.column(2), 4 << 20):
                part = batch.slice(lo, hi - lo)
                texts = part.column(2).to_pylist()
                rows = pd.DataFrame({"doc_id": part.column(0).to_pandas().astype("Int64"), "lang": part.column(1).to_pandas().astype(object)})
                rows["n_chars"] = [len(t or "") for t in texts]
                bits = pd.Series(_bits(texts, known, rest), dtype="Float64")
                out.append(rows.assign(bits=bits.where(rows["n_chars"] > 0, pd.NA)))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"doc_id": [], "lang": [], "n_chars": [], "bits": []})

    return dealt.groupBy("group").cogroup(answers.groupBy("group")).applyInPandas(add_up, "doc_id long, lang string, n_chars long, bits double")


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, share: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_chars, perplexity (of a character), threshold, trusted, kept of every row of docs.

    Trusted are ids with quality 1 in labels (doc_id, quality). The model is
    trained on all their texts but those with crc32(doc_id) mod 5 = 0, which
    give each language its threshold: the quantile of their bits a character,
    rounded up to a thousandth of a bit. Rows above their language's threshold
    are not kept. A language without such rows has no threshold, and a null or
    empty text no perplexity: both are kept. Null is a language of its own.
    Without trusted text all characters are equally unlikely. No rows give no
    rows.
    """
    scratch = Scratch(spark, "quality")
    trusted = scratch.keep(labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    calibrates = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    learned = trusted.where(~calibrates)
    if trusted.count() <= BROADCAST_IDS:
        learned = F.broadcast(learned)
    model, rest = fit(docs.select("doc_id", "text").join(learned, "doc_id", "left_semi"), scratch)
    # joined to the narrow result: the texts stay where they are
    found = scratch.keep(scored(spark, docs, model, rest).join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.col("trusted").isNotNull()))
    bins = (
        found.where(F.col("trusted") & calibrates & F.col("bits").isNotNull())
        .groupBy("lang", F.ceil(F.col("bits") * _BINS).alias("bin")).agg(F.count("*").alias("n"))
    )
    by_lang = Window.partitionBy("lang")
    ranked = bins.withColumn("up_to", F.sum("n").over(by_lang.orderBy("bin"))).withColumn("all", F.sum("n").over(by_lang))
    limits = ranked.where(F.col("up_to") >= share * F.col("all")).groupBy("lang").agg((F.min("bin") / _BINS).alias("limit"))
    limits = limits.withColumnRenamed("lang", "l")
    out = found.join(limits, F.col("lang").eqNullSafe(F.col("l")), "left")
    return out.select(
        "doc_id", "lang", "n_chars", F.pow(F.lit(2.0), "bits").alias("perplexity"), F.pow(F.lit(2.0), "limit").alias("threshold"), "trusted",
        F.coalesce(F.col("bits") <= F.col("limit"), F.lit(True)).alias("kept"),
    )
