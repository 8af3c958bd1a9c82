"""Exact dedup: tree-merge of sorted digest runs (DataFrame functions only).

Rows are dealt into ``runs`` runs by a hash of their id.  Each run is sorted
by digest and reduced to one entry per digest (the identifier that stays and
a count).  In every round ``fan_in`` neighbouring runs exchange their entries
and are merged in digest order (the aggregate over a struct is a sort
aggregate, i.e. a multiway merge of sorted input), retaining one identifier
per digest, until one run is left.  Each run is spread over all shuffle
partitions by digest, so no level is a single task, and a hot digest has at
most one entry per map task and run.

Equal means equal bytes.  Every level merges only entries whose SHA-256, byte
length and an unrelated 64-bit hash all agree, and the members of the final
groups are then compared byte by byte with the row that stays; rows that
differed (a digest collision) would be regrouped by their text.

Defined results: null text counts as empty text; an empty table gives an
empty result; rows repeated with the same id and text are all returned and
counted, and ``deduplicate`` returns one of them; a null id stays only if no
other id is in its group; extra columns are passed over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.rows import packed, unpacked
from wardline.session import stored

RUNS = 64        # leaf runs of the tree
FAN_IN = 8       # runs merged at once
KEY = ["_sha", "_bytes", "_check"]


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("_sha"),
                       F.octet_length(text).cast("long").alias("_bytes"), F.xxhash64(text).alias("_check"))


def _first(keep: str) -> Column:
    """The entry that stays: the smallest or largest id, a null id last."""
    if keep == "max":
        return F.max(F.struct(F.col("_id").isNotNull().alias("_has"), F.col("_id").alias("_id")))
    return F.min(F.struct(F.col("_id").isNull().alias("_has"), F.col("_id").alias("_id")))


def merge_tree(rows: DataFrame, keep: str = "min", runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """(key..., best struct, n): one entry per digest key, merged in rounds."""
    level = (rows.withColumn("_run", F.pmod(F.xxhash64("_id"), F.lit(runs)))
             .groupBy("_run", *KEY).agg(_first(keep).alias("_best"), F.count(F.lit(1)).alias("_n")))
    merge = F.max if keep == "max" else F.min
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (level.withColumn("_run", F.floor(F.col("_run") / F.lit(fan_in)))
                 .groupBy("_run", *KEY).agg(merge("_best").alias("_best"), F.sum("_n").alias("_n")))
    return level.drop("_run")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                 runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    full = _digests(docs, id_col, text_col)
    rows = stored(full.drop("_text"), "digests")
    groups = (merge_tree(rows, keep, runs, fan_in).where("_n > 1")
              .select(*KEY, F.col("_best._id").alias("_keep"), F.col("_n")))
    members = stored(full.join(stored(groups, "groups").hint("merge"), KEY), "members")
    same = F.col("_id").eqNullSafe(F.col("_keep"))
    heads = stored(members.where(same).dropDuplicates(KEY).select(*KEY, F.col("_text").alias("_head")), "heads")
    checked = members.join(heads.hint("merge"), KEY).withColumn("_equal", F.col("_text") == F.col("_head"))
    # digest collisions, should there be any: grouped by text, and taken from the group's count
    odd = stored(checked.where(~F.col("_equal")).drop("_head"), "collisions")
    by_text = odd.groupBy(*KEY, "_text").agg(_first(keep).alias("_best"), F.count(F.lit(1)).alias("_m"))
    regrouped = (odd.join(by_text.hint("merge"), [*KEY, "_text"])
                 .select("_id", *KEY, F.col("_best._id").alias("_keep"), F.col("_m").alias("_n")))
    less = odd.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_less"))
    equal = (checked.where("_equal").join(less.hint("merge"), KEY, "left")
             .select("_id", *KEY, "_keep", (F.col("_n") - F.coalesce("_less", F.lit(0))).alias("_n")))
    verified = (equal.unionByName(regrouped).dropDuplicates(["_id", *KEY])
                .select(F.col("_id").alias("_vid"), *[F.col(k).alias("_v" + k) for k in KEY], "_keep", "_n"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col("_v" + k) for k in KEY],
                F.col("_id").eqNullSafe(F.col("_vid")))
    found = F.col("_n").isNotNull()
    keep_id = F.when(found, F.col("_keep")).otherwise(F.col("_id"))
    return rows.join(verified.hint("merge"), on, "left").select(
        F.col("_id").alias(id_col), keep_id.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep_id).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                **tree) -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = (exact_groups(docs, id_col, text_col, keep, **tree).where("kept")
            .select(F.col(id_col).alias("_kid"), F.unhex("text_sha256").alias("_ksha")).dropDuplicates())
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    rows = packed(docs, _id=F.col(id_col), _sha=sha)
    on = F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_sha") == F.col("_ksha"))
    return unpacked(rows.join(kept.hint("merge"), on, "left_semi").dropDuplicates(["_id", "_sha"]), docs)
