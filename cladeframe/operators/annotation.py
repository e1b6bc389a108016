"""Function labels: representatives of groups, status of hits, expression by function."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.operators.store import numbered

from cladeframe.functions.text import AMINO, exact, normalized_protein

POLICIES = ("duplicate", "drop", "error")


def representatives(members: DataFrame, group: str = "orthogroup", gene: str = "gene_id", seq: str = "seq") -> DataFrame:
    """(group, representative, length, median_length, members, valid_members, invalid_members, seq_sha256, status).

    The target length is the upper middle of the valid members' sorted lengths; of the genes of that length the one with
    the fewest non-standard residues, then the smallest id. One aggregation per (group, length) counts and keeps the best gene of
    each length, so members are read once and a large group is a short histogram before any window.
    """
    own = members.withColumn("p", normalized_protein(F.col(seq))).withColumn("n", F.length("p"))
    odd = F.length(F.regexp_replace("p", f"[{AMINO}]", ""))
    best = F.min_by(F.when(F.col("p").isNotNull(), F.struct(gene, "p")), F.struct(odd, F.col(gene)))
    lengths = own.groupBy(group, "n").agg(F.count("*").alias("c"), F.count("p").alias("v"), best.alias("r"))
    whole = Window.partitionBy(group)
    lengths = lengths.withColumn("valid", F.sum("v").over(whole)).withColumn("upto", F.sum("v").over(whole.orderBy(F.col("n").asc_nulls_first())))
    holds = lambda k: (F.col("upto") > k) & (F.col("upto") - F.col("v") <= k)
    target = holds(F.floor(F.col("valid") / 2))
    out = lengths.groupBy(group).agg(
        F.sum("c").alias("members"), F.sum("v").alias("valid_members"), F.max(F.when(target, F.col("n"))).alias("target"), F.max(F.when(holds(F.floor((F.col("valid") - 1) / 2)), F.col("n"))).alias("lower"), F.max(F.when(target, F.col("r"))).alias("r"),
    )
    return out.select(
        group, F.col(f"r.{gene}").alias("representative"), F.col("target").alias("length"), ((F.col("target") + F.col("lower")) / 2).alias("median_length"),
        "members", "valid_members", (F.col("members") - F.col("valid_members")).alias("invalid_members"), F.sha2("r.p", 256).alias("seq_sha256"),
        F.when(F.col("target").isNull(), "no_valid_representative").otherwise("selected").alias("status"),
    )


def batch_labels(df: DataFrame, order: str, size: int) -> DataFrame:
    """batch_00000 and so on by position among the rows, in order."""
    return numbered(df, [order], "__at").withColumn("batch", F.format_string("batch_%05d", F.floor(F.col("__at") / size).cast("int"))).drop("__at")


def hit_status(genes: DataFrame, hits: DataFrame, gene: str = "gene_id", ko: str = "ko", status: str = "assignment_status") -> DataFrame:
    """(gene, assignment_status, accepted_ko_count, selected_ko): unique, ambiguous, threshold_missing, below_threshold or
    unannotated; selected_ko only if unique."""
    own = hits.groupBy(gene).agg(
        F.count_distinct(F.when(F.col(status) == "accepted", F.col(ko))).alias("accepted_ko_count"), F.min(F.when(F.col(status) == "accepted", F.col(ko))).alias("one"),
        F.bool_or(F.col(status) == "threshold_missing").alias("no_threshold"), F.bool_or(F.col(status) == "below_threshold").alias("below"),
    )
    out = genes.select(gene).distinct().join(own, gene, "left").na.fill(0, ["accepted_ko_count"])
    n = F.col("accepted_ko_count")
    label = F.when(n == 1, "unique").when(n > 1, "ambiguous").when(F.col("no_threshold"), "threshold_missing").when(F.col("below"), "below_threshold").otherwise("unannotated")
    return out.select(gene, label.alias("assignment_status"), n, F.when(n == 1, F.col("one")).alias("selected_ko"))


def group_assignments(representatives: DataFrame, status: DataFrame, group: str = "orthogroup", gene: str = "gene_id") -> DataFrame:
    """Representatives with their annotation; groups without a valid one say so, with 0 and null."""
    own = status.withColumnRenamed(gene, "representative")
    out = representatives.select(group, "representative").join(own, "representative", "left")
    label = F.when(F.col("representative").isNull(), "no_valid_representative").otherwise(F.coalesce("assignment_status", F.lit("unannotated")))
    return out.select(group, "representative", label.alias("assignment_status"), F.coalesce("accepted_ko_count", F.lit(0)).alias("accepted_ko_count"), "selected_ko")


def by_policy(assignments: DataFrame, policy: str, key: str, ko: str = "ko") -> DataFrame:
    """Assignments (key, ko) under a policy for keys with several: duplicate keeps all, drop none of them. With error the
    table is as with drop; give ambiguous_quantified to require()."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    own = assignments.select(key, ko).distinct()
    if policy == "duplicate":
        return own
    single = own.groupBy(key).agg(F.count("*").alias("__n")).where("__n = 1").select(key)
    return own.join(single, key, "left_semi")


def ambiguous_quantified(expression: DataFrame, assignments: DataFrame, key: str, ko: str = "ko") -> DataFrame:
    many = assignments.groupBy(key).agg(F.count_distinct(ko).alias("kos")).where("kos > 1")
    return expression.select(key).distinct().join(many, key)


def function_expression(expression: DataFrame, assignments: DataFrame, policy: str = "drop", sample: str = "sample", group: str = "orthogroup", ko: str = "ko", value: str = "tpm") -> DataFrame:
    """(sample, ko, contributing_groups, tpm_sum): every eligible label for every sample; null where nothing contributes.
    The axis of labels is crossed with the samples: that is the result's own size."""
    eligible = by_policy(assignments, policy, group, ko)
    sums = expression.join(eligible, group).groupBy(sample, ko).agg(F.count("*").alias("contributing_groups"), F.sum(exact(F.col(value))).cast("double").alias("tpm_sum"))
    axis = eligible.select(ko).distinct().crossJoin(expression.select(sample).distinct())
    return axis.join(sums, [sample, ko], "left").select(sample, ko, F.coalesce("contributing_groups", F.lit(0)).alias("contributing_groups"), "tpm_sum")


def gene_function_expression(abundance: DataFrame, hits: DataFrame, policy: str = "drop", sample: str = "sample", gene: str = "gene_id", ko: str = "ko", value: str = "tpm") -> DataFrame:
    """(sample, ko, annotated_genes, quantified_genes, tpm_sum) from accepted hits; the sum is null if no gene is quantified."""
    eligible = by_policy(hits.where(F.col("assignment_status") == "accepted").withColumn("__g", F.struct(sample, gene)), policy, "__g", ko)
    pairs = eligible.select(F.col(f"__g.{sample}").alias(sample), F.col(f"__g.{gene}").alias(gene), ko)
    both = pairs.join(abundance.select(sample, gene, exact(F.col(value)).alias("v")), [sample, gene], "left")
    return both.groupBy(sample, ko).agg(F.count("*").alias("annotated_genes"), F.count("v").alias("quantified_genes"), F.sum("v").cast("double").alias("tpm_sum"))


def status_partition(genes: DataFrame, abundance: DataFrame, sample: str = "sample", gene: str = "gene_id", value: str = "tpm") -> DataFrame:
    """(sample, status, genes, targets, tpm): genes, quantified targets and expression by assignment status; targets that
    are no gene are no_protein. A gene counts once, though it may feed several labels."""
    both = genes.select(sample, gene, "assignment_status").distinct().join(abundance.select(sample, gene, exact(F.col(value)).alias("v"), F.lit(1).alias("t")), [sample, gene], "full")
    status = F.coalesce("assignment_status", F.lit("no_protein")).alias("status")
    return both.groupBy(sample, status).agg(F.count("assignment_status").alias("genes"), F.count("t").alias("targets"), F.coalesce(F.sum("v"), F.lit(0)).cast("double").alias("tpm"))


def function_quality(expression: DataFrame, status: DataFrame, sample: str = "sample", group: str = "orthogroup", value: str = "tpm") -> DataFrame:
    """Per sample: observed, retained, ambiguous, unannotated and unrepresented groups, original and retained expression."""
    both = expression.join(status.select(group, "assignment_status"), group, "left")
    s = F.coalesce("assignment_status", F.lit("no_valid_representative"))
    v = exact(F.col(value))
    return both.groupBy(sample).agg(
        F.count("*").alias("observed"), F.count_if(s == "unique").alias("retained"), F.count_if(s == "ambiguous").alias("ambiguous"),
        F.count_if(s.isin("unannotated", "below_threshold", "threshold_missing")).alias("unannotated"), F.count_if(s == "no_valid_representative").alias("no_representative"),
        F.sum(v).cast("double").alias("original_tpm"), F.coalesce(F.sum(F.when(s == "unique", v)), F.lit(0)).cast("double").alias("retained_tpm"),
    )


def support(genes: DataFrame, assignments: DataFrame, targets: DataFrame, sample: str = "sample", gene: str = "gene_id", ko: str = "ko", value: str = "tpm") -> DataFrame:
    """(sample, ko, genes, quantified, tpm_sum): genes joined to assignments, targets where there are any."""
    both = genes.select(sample, gene).join(assignments.select(sample, gene, ko), [sample, gene]).join(targets.select(sample, gene, exact(F.col(value)).alias("v")), [sample, gene], "left")
    return both.groupBy(sample, ko).agg(F.count("*").alias("genes"), F.count("v").alias("quantified"), F.sum("v").cast("double").alias("tpm_sum"))
