"""Link counts of the n-gram Jaccard join.

Links stand within components only, so each component's distinct sets are
compared with one another: dealt into bands of sizes (sets that may link lie in
the same band or in neighbouring ones) and, within a band, into slots of a
bounded number of tokens.  Any two slots meet in one bounded group, which counts
common tokens by a product of incidence matrices.  Only sums per set come out,
never pairs, and copies count by the size of their class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import Lent, small_batches, stored
from kpiloom.llm.ngram_jaccard import Bitmap, JaccardConfig, _ids, _joined, _labelled, _lists, _rows, _slices, tokens_of

#: Tokens of a slot, about: bounds what two slots hold in a task.
TOKENS = 1 << 17
#: Distinct tokens of one incidence matrix.
COLUMNS = 1 << 12


def common_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of ``left`` shares with each of ``right``."""
    tokens = np.concatenate([*left, *right, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(t) for t in (*left, *right)])
    known, column = np.unique(tokens, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(known), COLUMNS):
        part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
        has = np.zeros((len(left) + len(right), min(COLUMNS, len(known) - at)), np.float32)
        has[owner[part], column[part] - at] = 1
        out += np.rint(has[:len(left)] @ has[len(left):].T).astype(np.int64)
    return out


def _block_sums(percent: int):
    """``sig, n_links`` of two slots: documents of the other one (or of the
    same one, without the set itself) that each set links with."""
    def run(pdf):
        import pandas as pd

        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        left, right = pdf[pdf["cell"] == low], pdf[pdf["cell"] == high]
        common = common_tokens(list(left["keys"]), list(right["keys"]))
        union = left["n"].to_numpy()[:, None] + right["n"].to_numpy()[None, :] - common
        hit = 100 * common >= percent * union
        if low == high:
            np.fill_diagonal(hit, False)
            return pd.DataFrame({"sig": left["sig"], "n_links": hit @ right["copies"].to_numpy()})
        return pd.DataFrame({"sig": pd.concat([left["sig"], right["sig"]]),
                             "n_links": np.concatenate([hit @ right["copies"].to_numpy(), left["copies"].to_numpy() @ hit])})

    return run


def _sets(texts: DataFrame, wanted: Bitmap, config: JaccardConfig, lent: Lent) -> DataFrame:
    """``node, sig, n, keys``: whole sets of the rows in ``wanted``."""
    sent = lent(wanted)

    def run(batches):
        for b in _slices(batches):
            ids = _ids(b, "doc_id")
            at = np.flatnonzero(sent.value.has(ids))
            sets = [tokens_of(b.column("text")[i].as_py(), config.words) for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at], pa.int64()), pa.array([xxhash.xxh3_128_digest(t.tobytes()) for t in sets], pa.binary()),
                 pa.array([len(t) for t in sets], pa.int64()), _lists(sets)], ["node", "sig", "n", "keys"])

    return texts.mapInArrow(run, "node long, sig binary, n long, keys array<long>")


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: JaccardConfig | None = None,
                rounds: int = 2) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, n_links``: near duplicates
    with the number of other documents whose set links with the row's.

    Texts that are null, empty or without words link with nothing (0); rows
    without an id have no component and a null count.  Rows that share an id
    are one document: each is counted by its own set, and a document of several
    sets counts once for each of them.  An empty table gives an empty result;
    other columns are left out, so none can clash.

    The work within a component is quadratic in its distinct sets of like size.
    """
    config, spark = config or JaccardConfig(), docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    with small_batches(spark):
        classes, first, joined = _joined(rows, config, rounds)
        known = classes.where("doc_id is not null and n > 0")
        copies = stored(known.groupBy("sig").agg(F.count_distinct("doc_id").alias("copies"), F.min("n").alias("n")), "copies")
        member = copies.join(first, "sig").join(joined, "node")
        several = member.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("component")
        step = max(math.log(100 / config.percent), 0.01) * 1.01  # similar sets lie at most one step apart
        member = member.join(several, "component", "left_semi").withColumn("band", F.floor(F.log("n") / step).cast("int"))
        slots = member.groupBy("component", "band").agg(F.ceil(F.sum("n") / TOKENS).cast("int").alias("slots"))
        member = stored(member.join(slots, ["component", "band"]).withColumn(
            "slot", F.pmod(F.xxhash64("sig"), F.col("slots")).cast("int")).drop("slots"), "members")
        slots = stored(slots, "slots")
        beside = member.select("*", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("to"))
        beside = beside.join(slots.withColumnRenamed("band", "to"), ["component", "to"]).select(
            "sig", "node", "component", "copies", F.struct("band", "slot").alias("cell"),
            F.explode(F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda s: F.struct(
                F.col("to").alias("band"), s.alias("slot")))).alias("other"))
        name = {c: F.concat_ws("/", f"{c}.band", f"{c}.slot") for c in ("cell", "other")}
        is_low = F.col("cell") <= F.col("other")
        beside = beside.select("sig", "node", "component", "copies", name["cell"].alias("cell"),
                               F.when(is_low, name["cell"]).otherwise(name["other"]).alias("low"),
                               F.when(is_low, name["other"]).otherwise(name["cell"]).alias("high"))
        with Lent(spark) as lent:
            texts = rows.where("doc_id is not null and text is not null")
            bits = config.bits_for(max(1, member.count()))
            sets = _sets(texts, Bitmap(member.select("node").distinct(), bits, 3), config, lent)
            sets = stored(sets.join(member.select("sig", "node"), ["sig", "node"], "left_semi").dropDuplicates(["sig"]), "sets")
        sums = (beside.join(sets.select("sig", "n", "keys"), "sig").groupBy("component", "low", "high")
                .applyInPandas(_block_sums(config.percent), "sig binary, n_links long")
                .groupBy("sig").agg(F.sum("n_links").alias("n_links")))
        own = copies.join(sums, "sig", "left").select("sig", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"))
        found = _labelled(classes, first, joined).join(stored(own, "counts"), "sig", "left")
        return found.select("doc_id", "n_shingles", "component_id", F.when(
            F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links"))
