"""Headers of logs: variants, families, roles, contracts; sessions; splits of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsense.functions.columns import strip_prefix


def stripped(names: Column) -> Column:
    """Header names without prefixes."""
    return F.transform(names, strip_prefix)


def fingerprint(names: Column) -> Column:
    """First 8 hex digits of the SHA-1 of the stripped names, joined by a vertical bar."""
    return F.substring(F.sha1(F.array_join(names, "|").cast("binary")), 1, 8)


def family_of(names: Column, markers: list[tuple[str, str]]) -> Column:
    """The first family whose marker is among the names, else ``unknown``."""
    return F.coalesce(*[F.when(F.array_contains(names, marker), F.lit(family)) for family, marker in markers], F.lit("unknown"))


def headers(df: DataFrame, markers: list[tuple[str, str]], header: str = "header") -> DataFrame:
    """``df`` with ``names, variant_id, family``."""
    named = df.withColumn("names", stripped(F.col(header)))
    return named.withColumn("variant_id", fingerprint(F.col("names"))).withColumn("family", family_of(F.col("names"), markers))


def resolve_roles(df: DataFrame, roles: DataFrame, labels: list[str], file: str = "file") -> DataFrame:
    """Per file: roles present, names without a role, label columns. ``roles``: ``(name, role)``, a fixed small table."""
    names = df.select(file, F.explode("names").alias("name")).join(F.broadcast(roles), "name", "left")
    is_label = F.col("name").isin(labels)
    return names.groupBy(file).agg(
        F.sort_array(F.collect_set("role")).alias("roles"),
        F.sort_array(F.collect_set(F.when(F.col("role").isNull() & ~is_label, F.col("name")))).alias("unknown"),
        F.sort_array(F.collect_set(F.when(is_label, F.col("name")))).alias("labels"),
    )


def variant_registry(df: DataFrame, file: str = "file") -> DataFrame:
    """One row per variant: family, columns, files. The files of a variant are counted and bounded, not listed."""
    return df.groupBy("variant_id").agg(F.first("family").alias("family"), F.first(F.size("names")).alias("n_cols"), F.count("*").alias("n_files"), F.min(file).alias("first_file"), F.max(file).alias("last_file"))


def moved_columns(df: DataFrame) -> DataFrame:
    """Names whose place differs between the variants of a family."""
    places = df.select("family", "variant_id", F.posexplode("names").alias("pos", "name")).select("family", "name", "pos").distinct()
    return places.groupBy("family", "name").agg(F.sort_array(F.collect_set("pos")).alias("places")).filter(F.size("places") > 1)


def session_of(folder: Column) -> tuple[Column, Column]:
    """``(date, run)`` of a folder named ``YYYYMMDD`` or ``YYYYMMDD_n`` (run 1 if none); nulls for other names."""
    pattern = r"^(\d{8})(?:_(\d+))?$"
    fits = folder.rlike(pattern)
    run = F.regexp_extract(folder, pattern, 2)
    return F.when(fits, F.regexp_extract(folder, pattern, 1)), F.when(fits, F.when(run == "", 1).otherwise(run.try_cast("int")))


def select_measured(df: DataFrame, contract: list[str]) -> DataFrame:
    """``df`` with the contract's columns that are ``present``, in its order, and those ``missing``."""
    wanted = F.array(*map(F.lit, contract))
    return df.withColumn("present", F.array_intersect(wanted, F.col("names"))).withColumn("missing", F.array_except(wanted, F.col("names")))


def duplicate_or_ragged(df: DataFrame, n_data: Column, file: str = "file") -> DataFrame:
    """Files to refuse: a name occurs twice after stripping, or rows have more columns than the header."""
    twice = F.size(F.array_distinct("names")) < F.size("names")
    reason = F.when(twice, "duplicate column names").when(n_data > F.size("names"), "more data columns than header names")
    return df.select(file, reason.alias("reason")).filter("reason is not null")


def filter_trials(trials: DataFrame, include_excluded: bool = False, unseal: bool = False) -> DataFrame:
    """Trials without the excluded ones; ``unseal`` makes the sealed split trainable."""
    kept = trials if include_excluded else trials.filter(~F.coalesce(F.col("exclude"), F.lit(False)))
    return kept.withColumn("split", F.lit("train")) if unseal else kept


def manifest_violations(trials: DataFrame) -> DataFrame:
    """What is wrong with a corpus manifest: required fields, split names, keys that repeat, nothing to train on."""
    key = F.concat_ws("/", F.coalesce(F.col("subject"), F.lit("?")), F.coalesce(F.col("session").cast("string"), F.lit("?")))
    missing = trials.filter("subject is null or session is null or annotated is null").select(key.alias("key"), F.lit("required field missing").alias("problem"))
    split = trials.filter(~F.coalesce(F.col("split").isin("train", "lockbox"), F.lit(False))).select(key.alias("key"), F.lit("unknown split").alias("problem"))
    twice = trials.groupBy(key.alias("key")).count().filter("count > 1").select("key", F.lit("key repeats").alias("problem"))
    usable = (F.col("split") == "train") & ~F.coalesce(F.col("exclude"), F.lit(False))
    none = trials.agg(F.coalesce(F.sum(usable.cast("long")), F.lit(0)).alias("n")).filter("n = 0").select(F.lit("").alias("key"), F.lit("nothing to train on").alias("problem"))
    return missing.unionByName(split).unionByName(twice).unionByName(none)


def declared_pairs(trials: DataFrame, files: DataFrame) -> DataFrame:
    """Trials with a raw pairing, and whether the file is there; a missing one is refused, not skipped."""
    there = files.select(F.col("path").alias("raw"), F.lit(True).alias("__there")).distinct()
    return trials.filter("raw is not null").join(there, "raw", "left").withColumn("refused", F.col("__there").isNull()).drop("__there")


def refuse(df: DataFrame, refused: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows that stay, number refused)`` by an anti and a semi join."""
    return df.join(refused, key, "left_anti"), df.join(refused, key, "left_semi").agg(F.count("*").alias("n_refused"))


def selected_features(available: list[str], drop: list[str]) -> list[str]:
    """All features but those dropped; a name that doesn't exist is an error."""
    if unknown := sorted(set(drop) - set(available)):
        raise ValueError(f"unknown features: {unknown}")
    return [c for c in available if c not in set(drop)]
