"""Which samples take part: completeness, exclusions, eligibility, refresh of representatives, review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.operators.store import numbered


def completeness(df: DataFrame, single: str = "single", duplicated: str = "duplicated", fragmented: str = "fragmented", missing: str = "missing", total: str = "total") -> DataFrame:
    """Adds completeness and bad: counts negative or not adding up to a positive total."""
    parts = [F.col(c) for c in (single, duplicated, fragmented, missing)]
    wrong = (F.col(total) <= 0) | (sum(parts[1:], parts[0]) != F.col(total)) | (F.least(*parts) < 0)
    return df.withColumn("bad", F.coalesce(wrong, F.lit(True))).withColumn("completeness", F.when(~F.col("bad"), (F.col(single) + F.col(duplicated)) / F.col(total)))


def select_complete(meta: DataFrame, counts: DataFrame, key: str, threshold: float) -> DataFrame:
    """Metadata left-joined to completeness; selected is false where counts lack, even at threshold 0."""
    out = meta.join(completeness(counts).select(key, "completeness"), key, "left")
    return out.withColumn("selected", F.coalesce(F.col("completeness") >= threshold, F.lit(False)))


def split_excluded(df: DataFrame, exclusions: DataFrame, key: str, reason: str = "reason", default: str = "manually excluded") -> tuple[DataFrame, DataFrame]:
    """(kept, excluded with a reason)."""
    own = exclusions.groupBy(key).agg(F.max(F.nullif(F.col(reason), F.lit(""))).alias(reason))
    return df.join(own, key, "left_anti"), df.drop(reason).join(own, key).withColumn(reason, F.coalesce(reason, F.lit(default)))


def selection_report(df: DataFrame, excluded: Column, outside: Column, below: Column) -> DataFrame:
    """reason by precedence: exclude list, outside list, below threshold; null if selected."""
    reason = F.when(excluded, "exclude_list").when(outside, "outside_list").when(below, "below_threshold")
    return df.withColumn("reason", reason)


def candidate_reasons(df: DataFrame, excluded_runs: DataFrame, run: str = "run", sample_group: str = "sample_group", exclusion: str = "exclusion", project: str = "bioproject", bases: str = "total_bases", wanted_group: str = "leaf", allowed_exclusion: str = "no") -> DataFrame:
    """First failing reason of each candidate, null if eligible, and its bases as a decimal."""
    runs = excluded_runs.select(F.col(run)).distinct().withColumn("__out", F.lit(True))
    amount = F.col(bases).try_cast("decimal(38,6)")
    out = df.join(runs, run, "left").withColumn("bases", amount)
    reason = (
        F.when(~F.col(sample_group).eqNullSafe(F.lit(wanted_group)), "sample_group")
        .when(~F.col(exclusion).eqNullSafe(F.lit(allowed_exclusion)), "exclusion")
        .when(F.col("__out"), "excluded_run")
        .when(F.coalesce(F.trim(project), F.lit("")) == "", "missing_project")
        .when(amount.isNull() | (amount <= 0), "invalid_bases")
    )
    return out.withColumn("reason", reason).drop("__out")


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def best_per_key(df: DataFrame, key: str, amount: str, tie: str, first: str | None = None) -> DataFrame:
    """One row per key: rows flagged `first` before others, then the largest amount, then the smallest tie; rows without an
    amount come last. One aggregation of one struct, which is combined before the shuffle; a key with many rows makes no
    large group."""
    lead = [~F.coalesce(F.col(first), F.lit(False))] if first else []
    order = F.struct(*lead, F.col(amount).isNull(), -F.col(amount), F.col(tie))
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def by_taxonomy(df: DataFrame, resolved: DataFrame, taxid: str = "taxid", policy: str = "exclude") -> DataFrame:
    """Adds resolved_taxid and taxid_reason (taxid_merged, taxid_unresolved or null) and included; resolved(taxid,
    resolved_taxid) holds the known taxids. Merged ids stay in; unresolved ones don't, whatever the policy, but "error"
    is for check: give its rows to require()."""
    out = df.join(resolved.select(F.col("taxid").alias(taxid), "resolved_taxid"), taxid, "left")
    reason = F.when(F.col("resolved_taxid").isNull(), "taxid_unresolved").when(F.col("resolved_taxid") != F.col(taxid), "taxid_merged")
    return out.withColumn("taxid_reason", reason).withColumn("included", F.col("resolved_taxid").isNotNull() | F.lit(policy == "keep"))


def refresh_decisions(previous: DataFrame, accepted: DataFrame, candidates: DataFrame, overrides: DataFrame, taxid: str = "taxid", run: str = "run") -> DataFrame:
    """(taxid, previous_run, run, decision, review) for every taxid of the four tables, each with one run per taxid:
    override, retained, unresolved, reselected, replacement, new or no_candidate. An accepted run stays; a run that is
    no longer accepted competes again with the candidates."""
    named = lambda df, name: df.select(taxid, F.col(run).alias(name))
    every = named(previous, "previous_run").join(named(accepted, "accepted_run"), taxid, "full").join(named(candidates, "candidate"), taxid, "full").join(named(overrides, "override"), taxid, "full")
    p, a, c, o = (F.col(x) for x in ("previous_run", "accepted_run", "candidate", "override"))
    decision = (
        F.when(o.isNotNull(), "override").when(a.isNotNull(), "retained").when(p.isNotNull() & c.isNull(), "unresolved")
        .when(p == c, "reselected").when(p.isNotNull(), "replacement").when(c.isNotNull(), "new").otherwise("no_candidate")
    )
    chosen = F.when(o.isNotNull(), o).when(a.isNotNull(), a).otherwise(c)
    out = every.select(taxid, p, chosen.alias(run), decision.alias("decision"))
    return out.withColumn("review", F.col("decision").isin("unresolved", "replacement", "no_candidate"))


def identity_drift(accepted: DataFrame, source: DataFrame, run: str = "run", columns: tuple[str, ...] = ("taxid", "scientific_name")) -> DataFrame:
    """Accepted rows with drift: columns whose value changed in the new source (empty: none; null: run not there)."""
    new = source.select(run, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__there"))
    changed = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in columns]))
    return accepted.join(new, run, "left").withColumn("drift", F.when(F.col("__there"), changed)).select(*accepted.columns, "drift")


def unchanged_evidence(evidence: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("taxid", "run", "scientific_name", "bioproject")) -> DataFrame:
    return evidence.join(current.select(*keys).distinct(), list(keys), "left_semi")


def review(runs: DataFrame, products: DataFrame, active: DataFrame, excluded: DataFrame, completeness_of: DataFrame, votes: DataFrame, threshold: float, run: str = "run") -> DataFrame:
    """(run, decision, reason, actions): hold while active or unfinished, exclude if listed, incomplete or discordant,
    else accept."""
    flag = lambda df, name: df.select(run).distinct().withColumn(name, F.lit(True))
    out = runs.select(run).distinct().join(flag(products, "done"), run, "left").join(flag(active, "busy"), run, "left").join(flag(excluded, "out"), run, "left")
    out = out.join(completeness_of.select(run, "completeness"), run, "left").join(votes.select(run, F.col("decision").alias("vote")), run, "left")
    reason = (
        F.when(F.col("out"), "excluded").when(F.col("busy"), "active").when(F.col("done").isNull(), "no_products").when(F.col("completeness").isNull(), "no_completeness")
        .when(F.col("completeness") < threshold, "below_threshold").when(F.col("vote") == "discordant", "discordant").when(F.col("vote").isNull(), "no_vote")
    )
    decision = F.when(reason.isNull(), "accept").when(reason.isin("excluded", "below_threshold", "discordant"), "exclude").otherwise("hold")
    actions = F.when(decision == "accept", F.array(F.lit("accept"), F.lit("exclude"))).when(decision == "exclude", F.array(F.lit("exclude"))).otherwise(F.array(F.lit("wait")))
    return out.select(run, decision.alias("decision"), reason.alias("reason"), actions.alias("actions"))


def evenly_spaced(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """count rows at even steps of the order, both ends included, indices rounded half to even."""
    out = numbered(df, order, "__at")
    out = out.crossJoin(F.broadcast(out.agg(F.count("*").alias("__n"))))  # one row
    step = lambda i: F.bround(i.cast("double") * (F.col("__n") - 1) / F.lit(max(1, count - 1)), 0).cast("long")
    wanted = F.when(F.col("__n") <= count, F.lit(True)).otherwise(F.array_contains(F.transform(F.sequence(F.lit(0), F.lit(max(0, count - 1))), step), F.col("__at")))
    return out.where(wanted).drop("__n", "__at")


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old, and the rows of new whose keys it lacks; columns of either stay."""
    return old.unionByName(new.join(old.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): equal bins, counted from 0; high itself falls into the last. Null: not assessed."""
    at = F.when(F.col(column).isNotNull(), F.least(F.floor((F.col(column) - low) / ((high - low) / bins)), F.lit(bins - 1))).cast("int")
    return df.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
