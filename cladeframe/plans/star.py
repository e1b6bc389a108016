"""The operators bound to a star schema (orders, parts, suppliers, events, documents), each beside its SQL.

The same functions run on expression tables; only names differ. A supplier stands for a sample, a part for a gene, a
brand for a gene group, a part type for a function label or marker, a customer for a species or tip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.functions import text as T
from cladeframe.operators import annotation, checks, expression, forest, identity, mapping, markers, selection, subset, sums, taxonomy, votes
from cladeframe.operators.intervals import prefix_sums
from cladeframe.operators.store import stored, tasks_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str):
    return F.col(c).cast("string")


# --- expression: supplier, part, summed quantity; brands of parts with p_size <= 40 ---------------------------------

ABUNDANCE_SQL = """
abundance AS (SELECT l_suppkey AS sample, l_partkey AS gene_id, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY ALL),
mapping AS (SELECT a.sample, a.gene_id, CASE WHEN p.p_size <= 40 THEN p.p_brand END AS orthogroup FROM abundance a JOIN part p ON p.p_partkey = a.gene_id),
labels AS (SELECT DISTINCT orthogroup, unnest(CASE WHEN orthogroup LIKE '%5' THEN [] WHEN orthogroup LIKE '%2' OR orthogroup LIKE '%4' THEN [lo, hi] ELSE [hi] END) AS ko FROM (SELECT p_brand AS orthogroup, min(p_type) AS lo, max(p_type) AS hi FROM part GROUP BY 1))
"""


def abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("gene_id"), F.col("l_quantity").cast("decimal(18,2)").alias("v"))
    return own.repartition(tasks_for(own), "sample", "gene_id").groupBy("sample", "gene_id").agg(F.sum("v").alias("tpm"))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("gene_id"))
    tasks = tasks_for(genes)
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene_id"), F.when(F.col("p_size") <= 40, F.col("p_brand")).alias("orthogroup"))
    both = genes.repartition(tasks, "gene_id").distinct().join(part.repartition(tasks, "gene_id").hint("merge"), "gene_id")
    return both.repartition(tasks, "sample", "gene_id").select("gene_id", "sample", "orthogroup")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and last type of each brand: none, one or both of them."""
    own = read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("orthogroup")).agg(F.min("p_type").alias("lo"), F.max("p_type").alias("hi"))
    digit = F.right("orthogroup", F.lit(1))
    some = F.when(digit == "5", F.array().cast("array<string>")).when(digit.isin("2", "4"), F.array("lo", "hi")).otherwise(F.array("hi"))
    return own.select("orthogroup", F.explode(some).alias("ko")).distinct()


def group_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.group_expression(abundance(spark, sf_dir), brands(spark, sf_dir))


GROUPS_SQL = f"WITH {ABUNDANCE_SQL}, sums AS (SELECT a.sample, m.orthogroup, sum(a.v) AS s FROM abundance a JOIN mapping m USING (sample, gene_id) WHERE m.orthogroup IS NOT NULL GROUP BY ALL)"


@query(f"{GROUPS_SQL} SELECT sample, orthogroup, round(CAST(s AS DOUBLE), 6) AS tpm_sum, round(CAST(s AS DOUBLE) / CAST(sum(s) OVER (PARTITION BY sample) AS DOUBLE) * 1000000, 6) AS tpm FROM sums")
def group_expression(spark, sf_dir):
    """AG-01, JN-05, PR-18: sums per sample and group, renormalised to a million."""
    return group_table(spark, sf_dir).select("sample", "orthogroup", F.round("tpm_sum", 6).alias("tpm_sum"), F.round("tpm", 6).alias("tpm"))


@query(f"""WITH {ABUNDANCE_SQL} SELECT a.sample, count(*) AS targets, count(*) AS protein_genes, count(m.orthogroup) AS mapped_targets, count(DISTINCT m.orthogroup) AS orthogroups,
 round(CAST(sum(a.v) AS DOUBLE), 6) AS total_tpm, round(CAST(coalesce(sum(a.v) FILTER (WHERE m.orthogroup IS NOT NULL), 0) AS DOUBLE) / CAST(sum(a.v) AS DOUBLE), 9) AS mapped_tpm_fraction
 FROM abundance a JOIN mapping m USING (sample, gene_id) GROUP BY a.sample""")
def expression_quality(spark, sf_dir):
    """AG-02: mapping quality per sample."""
    out = expression.expression_quality(abundance(spark, sf_dir), brands(spark, sf_dir))
    return out.select("sample", "targets", "protein_genes", "mapped_targets", "orthogroups", F.round("total_tpm", 6).alias("total_tpm"), F.round("mapped_tpm_fraction", 9).alias("mapped_tpm_fraction"))


@query(f"WITH {ABUNDANCE_SQL} SELECT a.sample, a.gene_id, m.orthogroup AS groups, CAST(a.v AS VARCHAR) AS tpm_text, CAST(a.v AS DOUBLE) AS tpm FROM abundance a JOIN mapping m USING (sample, gene_id)")
def sequence_expression(spark, sf_dir):
    """SO-08, PR-07: every sequence of every sample, text of values unchanged."""
    return expression.sequence_table(abundance(spark, sf_dir), brands(spark, sf_dir)).select("sample", "gene_id", "groups", "tpm_text", "tpm")


AXIS = [f"Brand#{i}" for i in range(1, 26)]


@query(f"{GROUPS_SQL} SELECT sample, " + ", ".join(f"coalesce(max(CAST(s AS DOUBLE)) FILTER (WHERE orthogroup = '{b}'), 0.0) AS \"{b}\"" for b in AXIS) + " FROM sums GROUP BY sample")
def wide_expression(spark, sf_dir):
    """IO-13, SO-04: one row per sample, zeros for groups not seen."""
    return expression.wide(group_table(spark, sf_dir), "sample", "orthogroup", "tpm_sum", AXIS, 0.0)


@query(f"WITH {ABUNDANCE_SQL} SELECT DISTINCT sample, gene_id, orthogroup FROM mapping")
def map_genes(spark, sf_dir):
    """JN-06: all genes with their groups, unmapped ones kept."""
    own = brands(spark, sf_dir)
    return mapping.map_genes(own.select("sample", "gene_id"), own.na.fill(""))


@query("""WITH pairs AS (SELECT l_suppkey AS sample, l_partkey AS gene_id, l_returnflag AS orthogroup FROM lineitem),
 per AS (SELECT sample, gene_id, count(DISTINCT orthogroup) AS g, count(*) AS n FROM pairs GROUP BY ALL)
 SELECT sample, count(*) AS protein_genes, CAST(sum(g) AS BIGINT) AS unique_gene_og_pairs, CAST(sum(n) AS BIGINT) AS input_annotation_rows, CAST(sum(n) - sum(g) AS BIGINT) AS duplicate_pairs_removed, count(*) FILTER (WHERE g > 1) AS ambiguous_genes FROM per GROUP BY sample""")
def mapping_quality(spark, sf_dir):
    """AG-09, JN-18: rows, unique pairs, duplicates and ambiguous genes per sample."""
    pairs = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("gene_id"), F.col("l_returnflag").alias("orthogroup"))
    return mapping.mapping_counts(pairs.select("sample", "gene_id"), pairs)


@query("""WITH t AS (SELECT count(DISTINCT l_suppkey) AS total FROM lineitem), o AS (SELECT l_partkey AS orthogroup, count(DISTINCT l_suppkey) AS samples FROM lineitem GROUP BY ALL)
 SELECT orthogroup, samples, total, round(samples / total, 9) AS fraction, samples >= ceil(CAST('0.26' AS DECIMAL(10,4)) * total) AS selected FROM o, t""")
def occupancy(spark, sf_dir):
    """AG-08, PR-17: distinct samples per group, exact inclusive cut."""
    own = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("orthogroup"))
    return mapping.occupancy(own, "0.26").withColumn("fraction", F.round("fraction", 9))


# --- function labels -----------------------------------------------------------------------------------------------

ALL_LABELS_SQL = "labels AS (SELECT DISTINCT p_brand AS orthogroup, p_type AS ko FROM part WHERE p_size = 1)"


def all_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every type of each brand among the parts of size 1: many labels a group."""
    return read(spark, sf_dir, "part").where("p_size = 1").select(F.col("p_brand").alias("orthogroup"), F.col("p_type").alias("ko")).distinct()


def policy_sql(policy: str) -> str:
    keep = "" if policy == "duplicate" else " WHERE orthogroup IN (SELECT orthogroup FROM labels GROUP BY 1 HAVING count(*) = 1)"
    return f"""{GROUPS_SQL}, e AS (SELECT * FROM labels{keep}), axis AS (SELECT * FROM (SELECT DISTINCT ko FROM e), (SELECT DISTINCT sample FROM sums)),
 k AS (SELECT s.sample, e.ko, count(*) AS n, sum(s.s) AS v FROM sums s JOIN e USING (orthogroup) GROUP BY ALL)
 SELECT sample, ko, coalesce(n, 0) AS contributing_groups, CAST(v AS DOUBLE) AS tpm_sum FROM axis LEFT JOIN k USING (sample, ko)"""


@query(policy_sql("drop"))
def function_expression_drop(spark, sf_dir):
    """AG-03, JN-07: expression by label from groups, groups with several labels dropped."""
    return annotation.function_expression(group_table(spark, sf_dir), labels(spark, sf_dir), "drop", value="tpm_sum")


@query(policy_sql("duplicate").replace(next(x for x in ABUNDANCE_SQL.splitlines() if x.startswith("labels AS")), ALL_LABELS_SQL))
def function_expression_duplicate(spark, sf_dir):
    """AG-03, JN-07: expression by label from groups, groups with several labels counted for each."""
    return annotation.function_expression(group_table(spark, sf_dir), all_labels(spark, sf_dir), "duplicate", value="tpm_sum")


def gene_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per supplier and part: two labels for even sizes, accepted or not by size."""
    part = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("gene_id"),
        F.explode(F.when(F.col("p_size") % 2 == 0, F.array("p_type", "p_brand")).otherwise(F.array("p_type"))).alias("ko"),
        F.when(F.col("p_size") <= 10, "accepted").when(F.col("p_size") <= 30, "below_threshold").otherwise("threshold_missing").alias("assignment_status"),
    )
    return brands(spark, sf_dir).select("sample", "gene_id").join(part, "gene_id")


HITS_SQL = """hits AS (SELECT m.sample, m.gene_id, u.ko, CASE WHEN p_size <= 10 THEN 'accepted' WHEN p_size <= 30 THEN 'below_threshold' ELSE 'threshold_missing' END AS assignment_status
 FROM mapping m JOIN part p ON p.p_partkey = m.gene_id, unnest(CASE WHEN p_size % 2 = 0 THEN [p_type, p_brand] ELSE [p_type] END) AS u(ko))"""
STATUS_SQL = """status AS (SELECT gene_id, CASE WHEN n = 1 THEN 'unique' WHEN n > 1 THEN 'ambiguous' WHEN tm THEN 'threshold_missing' WHEN bt THEN 'below_threshold' ELSE 'unannotated' END AS assignment_status, n AS accepted_ko_count, CASE WHEN n = 1 THEN k END AS selected_ko
 FROM (SELECT gene_id, count(DISTINCT ko) FILTER (WHERE assignment_status = 'accepted') AS n, min(ko) FILTER (WHERE assignment_status = 'accepted') AS k, bool_or(assignment_status = 'threshold_missing') AS tm, bool_or(assignment_status = 'below_threshold') AS bt FROM hits GROUP BY 1))"""


@query(f"""WITH {ABUNDANCE_SQL}, {HITS_SQL}, ok AS (SELECT DISTINCT sample, gene_id, ko FROM hits WHERE assignment_status = 'accepted'),
 e AS (SELECT * FROM ok QUALIFY count(*) OVER (PARTITION BY sample, gene_id) = 1)
 SELECT e.sample, ko, count(*) AS annotated_genes, count(v) AS quantified_genes, CAST(sum(v) AS DOUBLE) AS tpm_sum FROM e LEFT JOIN abundance a ON a.sample = e.sample AND a.gene_id = e.gene_id AND a.gene_id % 3 > 0 GROUP BY ALL""")
def gene_function_expression(spark, sf_dir):
    """AG-04, JN-08: expression by label from genes; null where no gene is quantified."""
    return annotation.gene_function_expression(abundance(spark, sf_dir).where("gene_id % 3 > 0"), gene_labels(spark, sf_dir))


@query(f"WITH {ABUNDANCE_SQL}, {HITS_SQL}, {STATUS_SQL} SELECT * FROM status")
def hit_status(spark, sf_dir):
    """AG-07: status of each gene from its hits."""
    own = gene_labels(spark, sf_dir)
    return annotation.hit_status(own, own)


@query(f"""WITH {ABUNDANCE_SQL}, {HITS_SQL}, {STATUS_SQL}, g AS (SELECT DISTINCT m.sample, m.gene_id, s.assignment_status FROM mapping m JOIN status s USING (gene_id) WHERE m.gene_id % 5 > 0)
 SELECT coalesce(g.sample, a.sample) AS sample, coalesce(assignment_status, 'no_protein') AS status, count(assignment_status) AS genes, count(v) AS targets, CAST(coalesce(sum(v), 0) AS DOUBLE) AS tpm
 FROM g FULL JOIN (SELECT * FROM abundance WHERE gene_id % 3 > 0) a ON a.sample = g.sample AND a.gene_id = g.gene_id GROUP BY ALL""")
def status_partition(spark, sf_dir):
    """AG-05: genes, targets and expression by status."""
    own = gene_labels(spark, sf_dir)
    genes = own.select("sample", "gene_id").distinct().join(annotation.hit_status(own, own), "gene_id").where("gene_id % 5 > 0")
    return annotation.status_partition(genes, abundance(spark, sf_dir).where("gene_id % 3 > 0"))


MEMBERS_SQL = """members AS (SELECT lang || '/' || source AS orthogroup, doc_id AS gene_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq FROM documents),
 m AS (SELECT *, length(seq) AS n, seq = '' AS bad FROM members), v AS (SELECT *, row_number() OVER (PARTITION BY orthogroup ORDER BY n) AS rn, count(*) OVER (PARTITION BY orthogroup) AS c FROM m WHERE NOT bad),
 t AS (SELECT orthogroup, max(n) FILTER (WHERE rn = c // 2 + 1) AS target, max(n) FILTER (WHERE rn = (c - 1) // 2 + 1) AS lower FROM v GROUP BY 1),
 r AS (SELECT v.orthogroup, gene_id, seq, target, lower, row_number() OVER (PARTITION BY v.orthogroup ORDER BY length(regexp_replace(seq, '[ACDEFGHIKLMNPQRSTVWY]', '', 'g')), gene_id) AS k FROM v JOIN t ON v.orthogroup = t.orthogroup AND v.n = t.target),
 reps AS (SELECT a.orthogroup, r.gene_id AS representative, r.target AS length, (r.target + r.lower) / 2 AS median_length, a.members, a.valid_members, a.members - a.valid_members AS invalid_members, sha256(r.seq) AS seq_sha256, CASE WHEN r.gene_id IS NULL THEN 'no_valid_representative' ELSE 'selected' END AS status
  FROM (SELECT orthogroup, count(*) AS members, count(*) FILTER (WHERE NOT bad) AS valid_members FROM m GROUP BY 1) a LEFT JOIN r ON r.orthogroup = a.orthogroup AND r.k = 1)"""


def representative_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "documents").select(F.concat_ws("/", "lang", "source").alias("orthogroup"), F.col("doc_id").alias("gene_id"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))
    return annotation.representatives(own)


@query(f"WITH {MEMBERS_SQL} SELECT * FROM reps")
def representatives(spark, sf_dir):
    """WN-01, PR-15, FN-04, FN-06: median-length representative of each group."""
    return representative_table(spark, sf_dir)


@query(f"WITH {MEMBERS_SQL} SELECT orthogroup, representative, printf('batch_%05d', (row_number() OVER (ORDER BY orthogroup) - 1) // 7) AS batch FROM reps WHERE status = 'selected'")
def batches(spark, sf_dir):
    """WN-10: batch labels by position."""
    return annotation.batch_labels(representative_table(spark, sf_dir).where("status = 'selected'").select("orthogroup", "representative"), "orthogroup", 7)


ASSIGN_SQL = f"""WITH {ABUNDANCE_SQL}, st AS (SELECT orthogroup, count(*) AS n, min(ko) AS k FROM labels GROUP BY 1),
 asg AS (SELECT b.orthogroup, CASE WHEN n IS NULL THEN 'unannotated' WHEN n = 1 THEN 'unique' ELSE 'ambiguous' END AS assignment_status, coalesce(n, 0) AS accepted_ko_count, CASE WHEN n = 1 THEN k END AS selected_ko FROM (SELECT DISTINCT p_brand AS orthogroup FROM part) b LEFT JOIN st USING (orthogroup))"""


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = labels(spark, sf_dir).select(F.concat(F.lit("rep "), "orthogroup").alias("gene_id"), "ko", F.lit("accepted").alias("assignment_status"))
    reps = read(spark, sf_dir, "part").select(F.col("p_brand").alias("orthogroup")).distinct().withColumn("representative", F.concat(F.lit("rep "), "orthogroup"))
    return annotation.group_assignments(reps, annotation.hit_status(own, own))


@query(f"{ASSIGN_SQL} SELECT orthogroup, 'rep ' || orthogroup AS representative, assignment_status, accepted_ko_count, selected_ko FROM asg")
def group_assignments(spark, sf_dir):
    """JN-09: representatives with their annotation and its defaults."""
    return assignments(spark, sf_dir)


@query(f"""{ASSIGN_SQL}, sums AS (SELECT a.sample, m.orthogroup, sum(a.v) AS s FROM abundance a JOIN mapping m USING (sample, gene_id) WHERE m.orthogroup IS NOT NULL GROUP BY ALL)
 SELECT sample, count(*) AS observed, count(*) FILTER (WHERE assignment_status = 'unique') AS retained, count(*) FILTER (WHERE assignment_status = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE assignment_status = 'unannotated') AS unannotated, 0 AS no_representative,
 CAST(sum(s) AS DOUBLE) AS original_tpm, CAST(coalesce(sum(s) FILTER (WHERE assignment_status = 'unique'), 0) AS DOUBLE) AS retained_tpm FROM sums JOIN asg USING (orthogroup) GROUP BY sample""")
def function_quality(spark, sf_dir):
    """AG-06: quality of the group route."""
    return annotation.function_quality(group_table(spark, sf_dir), assignments(spark, sf_dir), value="tpm_sum")


@query(f"""WITH {ABUNDANCE_SQL}, x AS (SELECT sample, sum(v) AS s FROM abundance GROUP BY 1), y AS (SELECT l_suppkey AS sample, sum(CAST(l_quantity AS DECIMAL(18,2))) AS s FROM lineitem WHERE l_suppkey % 9 > 0 GROUP BY 1)
 SELECT x.sample, CAST(x.s AS DOUBLE) AS expected, CAST(y.s AS DOUBLE) AS actual FROM x LEFT JOIN y USING (sample) WHERE y.s IS NULL OR x.s <> y.s""")
def reconciliation(spark, sf_dir):
    """AG-24, FN-02, FN-03: totals re-derived from the raw table, with differences and gaps."""
    totals = expression.total_of(abundance(spark, sf_dir), "tpm", "sample")
    raw = read(spark, sf_dir, "lineitem").where("l_suppkey % 9 > 0").select(F.col("l_suppkey").alias("sample"), F.col("l_quantity").alias("tpm"))
    return expression.reconcile(totals, expression.total_of(raw, "tpm", "sample"), ["sample"], "tpm")


# --- selection and refresh -------------------------------------------------------------------------------------------

@query("SELECT o_custkey AS taxid, o_orderkey AS run, o_totalprice AS bases FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def best_run(spark, sf_dir):
    """WN-02: largest amount per key, then the smallest id."""
    own = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("taxid"), F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("bases"))
    return selection.best_per_key(own, "taxid", "bases", "run")


REFRESH_SQL = """WITH b AS (SELECT o_custkey AS taxid, o_orderkey AS run, o_orderdate < TIMESTAMP '1998-01-01' AS early, o_orderstatus AS s, o_totalprice AS p FROM orders),
 prev AS (SELECT taxid, run FROM b WHERE early QUALIFY row_number() OVER (PARTITION BY taxid ORDER BY p DESC, run) = 1), cand AS (SELECT taxid, run FROM b WHERE s <> 'P' QUALIFY row_number() OVER (PARTITION BY taxid ORDER BY p DESC, run) = 1),
 acc AS (SELECT p.taxid, p.run FROM prev p JOIN b USING (taxid, run) WHERE s = 'F'), ovr AS (SELECT taxid, run FROM cand WHERE taxid % 11 = 0),
 f AS (SELECT taxid, prev.run AS p, acc.run AS a, cand.run AS c, ovr.run AS o FROM prev FULL JOIN acc USING (taxid) FULL JOIN cand USING (taxid) FULL JOIN ovr USING (taxid)),
 d AS (SELECT taxid, p AS previous_run, coalesce(o, a, c) AS run, CASE WHEN o IS NOT NULL THEN 'override' WHEN a IS NOT NULL THEN 'retained' WHEN p IS NOT NULL AND c IS NULL THEN 'unresolved' WHEN p = c THEN 'reselected' WHEN p IS NOT NULL THEN 'replacement' WHEN c IS NOT NULL THEN 'new' ELSE 'no_candidate' END AS decision FROM f)"""


def refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("taxid"), F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("bases"), F.col("o_orderstatus").alias("s"), (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).alias("early"))
    best = lambda df: selection.best_per_key(df, "taxid", "bases", "run")
    previous, candidates = best(own.where("early")), best(own.where("s <> 'P'"))
    return selection.refresh_decisions(previous, previous.where("s = 'F'"), candidates, candidates.where("taxid % 11 = 0"))


@query(f"{REFRESH_SQL} SELECT *, decision IN ('unresolved', 'replacement', 'no_candidate') AS review FROM d")
def refresh_decisions(spark, sf_dir):
    """JN-19: decision per key from previous, accepted, candidates and overrides."""
    return refresh(spark, sf_dir)


@query(f"{REFRESH_SQL} SELECT decision, count(*) AS n FROM d GROUP BY 1")
def refresh_counts(spark, sf_dir):
    """AG-21: counters of decisions."""
    return selection.count_by(refresh(spark, sf_dir), "decision")


@query("""WITH o AS (SELECT o_orderkey AS run, o_custkey AS taxid, o_orderpriority AS name FROM orders)
 SELECT run, taxid, name, CASE WHEN run % 7 = 0 THEN NULL ELSE list_filter([CASE WHEN run % 2 = 0 THEN 'taxid' END, CASE WHEN run % 5 = 0 THEN 'name' END], lambda x: x IS NOT NULL) END AS drift FROM o""")
def identity_drift(spark, sf_dir):
    """JN-20: accepted rows whose identity changed in the new source, or that are gone from it."""
    own = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_custkey").alias("taxid"), F.col("o_orderpriority").alias("name"))
    new = own.where("run % 7 <> 0").select("run", F.when(F.col("run") % 2 == 0, F.col("taxid") + 1).otherwise(F.col("taxid")).alias("taxid"), F.when(F.col("run") % 5 == 0, F.lit("x")).otherwise(F.col("name")).alias("name"))
    return selection.identity_drift(own, new, columns=("taxid", "name"))


@query("SELECT o_custkey AS taxid, o_orderkey AS run, o_orderpriority AS scientific_name, o_orderstatus AS bioproject FROM orders WHERE o_orderkey % 4 <> 0")
def unchanged_evidence(spark, sf_dir):
    """JN-21: evidence of rows that are unchanged in four columns."""
    own = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("taxid"), F.col("o_orderkey").alias("run"), F.col("o_orderpriority").alias("scientific_name"), F.col("o_orderstatus").alias("bioproject"))
    return selection.unchanged_evidence(own, own.withColumn("bioproject", F.when(F.col("run") % 4 == 0, F.lit("other")).otherwise(F.col("bioproject"))))


@query("""SELECT o_orderkey AS k, o_orderstatus AS s, 'old' AS r, CAST(NULL AS DOUBLE) AS price FROM orders WHERE o_orderkey % 2 = 0
 UNION ALL SELECT o_orderkey, o_orderstatus, 'new', o_totalprice FROM orders WHERE o_orderkey % 2 <> 0""")
def append_new(spark, sf_dir):
    """SO-01, PR-09: existing keys win, custom columns stay."""
    own = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("price"))
    return selection.append_new(own.where("k % 2 = 0").drop("price").withColumn("r", F.lit("old")), own.where("k % 2 <> 0 or k % 3 = 0").withColumn("r", F.lit("new")), "k")


COUNTS_SQL = """counts AS (SELECT o_custkey AS sample, count(*) FILTER (WHERE o_orderstatus = 'F') AS single, count(*) FILTER (WHERE o_orderstatus = 'O') AS duplicated, count(*) FILTER (WHERE o_orderstatus = 'P') AS fragmented, count(*) AS total FROM orders GROUP BY 1)"""


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = lambda s, name: F.count_if(F.col("o_orderstatus") == s).alias(name)
    out = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sample")).agg(has("F", "single"), has("O", "duplicated"), has("P", "fragmented"), F.count("*").alias("total"))
    return out.withColumn("missing", F.lit(0).cast("long"))


@query(f"WITH {COUNTS_SQL} SELECT c_custkey AS sample, round((single + duplicated) / total, 9) AS completeness, coalesce((single + duplicated) / total >= 0.6, false) AS selected FROM customer LEFT JOIN counts ON c_custkey = sample")
def completeness(spark, sf_dir):
    """PR-11, JN-01: completeness left-joined to metadata, missing never selected."""
    meta = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample"))
    return selection.select_complete(meta, order_counts(spark, sf_dir), "sample", 0.6).withColumn("completeness", F.round("completeness", 9))


@query("SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'exclude_list' WHEN c_mktsegment = 'BUILDING' THEN 'outside_list' WHEN c_acctbal < 1000 THEN 'below_threshold' END AS reason FROM customer")
def selection_report(spark, sf_dir):
    """PR-13: one reason by precedence."""
    own = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return selection.selection_report(own, F.col("c_nationkey") % 5 == 0, F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") < 1000).select("c_custkey", "reason")


@query("""SELECT o_orderkey AS run, CASE WHEN o_orderstatus <> 'F' THEN 'sample_group' WHEN o_custkey % 10 = 0 THEN 'exclusion' WHEN o_orderkey % 17 = 0 THEN 'excluded_run' WHEN o_orderkey % 13 = 0 THEN 'missing_project' WHEN o_totalprice < 100000 THEN 'invalid_bases' END AS reason FROM orders""")
def candidate_reasons(spark, sf_dir):
    """PR-14: first failing reason of candidates."""
    own = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run"), F.col("o_orderstatus").alias("sample_group"), F.when(F.col("o_custkey") % 10 == 0, "contaminated").otherwise("no").alias("exclusion"),
        F.when(F.col("o_orderkey") % 13 == 0, " ").otherwise("P").alias("bioproject"), F.when(F.col("o_totalprice") < 100000, F.lit("0")).otherwise(text("o_totalprice")).alias("total_bases"),
    )
    out = selection.candidate_reasons(own, own.where("run % 17 = 0").select("run"), wanted_group="F")
    return out.select("run", "reason")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def kept_after_exclusion(spark, sf_dir):
    """JN-03: kept part of the split by an exclusion list."""
    return _split(spark, sf_dir)[0]


@query("SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey % 2 = 0 THEN 'manually excluded' ELSE n_name END AS reason FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def excluded_with_reason(spark, sf_dir):
    """JN-03: excluded part with its reason."""
    return _split(spark, sf_dir)[1]


def _split(spark: SparkSession, sf_dir: str):
    out = read(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 2 == 0, "").otherwise(F.col("n_name")).alias("reason"))
    return selection.split_excluded(read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), out, "c_nationkey")


@query("SELECT c_custkey AS sample, c_nationkey AS species_id, CASE WHEN c_nationkey % 3 < 2 THEN CAST(c_nationkey % 3 AS VARCHAR) END AS trait FROM customer WHERE c_nationkey % 3 < 2")
def inherited_traits(spark, sf_dir):
    """JN-04, PR-05: trait of the species for every sample; phenotyped subset."""
    traits = read(spark, sf_dir, "nation").where("n_nationkey % 3 < 2").select(F.col("n_nationkey").alias("species_id"), (F.col("n_nationkey") % 3).cast("string").alias("trait"))
    samples = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample"), F.col("c_nationkey").alias("species_id"))
    return identity.phenotyped(identity.inherit_trait(samples, traits, "trait"), "trait")


@query("SELECT DISTINCT c_name AS sample FROM customer WHERE c_nationkey IN (3, 4) OR c_custkey % 50 = 0")
def expanded_selectors(spark, sf_dir):
    """PR-12: species ids stand for all their samples."""
    samples = read(spark, sf_dir, "customer").select(F.concat(F.lit("N"), text("c_nationkey")).alias("species_id"), F.col("c_name").alias("sample"), "c_custkey")
    asked = samples.where("c_custkey % 50 = 0").select(F.col("sample").alias("selector")).union(samples.where("species_id in ('N3', 'N4')").select("species_id"))
    return identity.expand_selectors(samples, asked)


@query("""WITH x AS (SELECT s_suppkey, s_name, s_acctbal, row_number() OVER (ORDER BY s_acctbal, s_suppkey) - 1 AS place, count(*) OVER () AS n FROM supplier), i AS (SELECT DISTINCT CAST(round_even(k * (n - 1) / 10, 0) AS BIGINT) AS place FROM (SELECT DISTINCT n FROM x), generate_series(0, 10) g(k))
 SELECT s_suppkey, s_acctbal FROM x JOIN i USING (place)""")
def pilot_items(spark, sf_dir):
    """WN-08: evenly spaced sample of the order, ends included."""
    return selection.evenly_spaced(read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal", "s_suppkey"], 11)


@query("SELECT CAST(least(floor((c_acctbal + 1000) / 550), 19) AS INTEGER) AS bin, count(*) AS n FROM customer GROUP BY 1")
def balance_histogram(spark, sf_dir):
    """AG-22: equal bins."""
    return selection.histogram(read(spark, sf_dir, "customer"), "c_acctbal", -1000.0, 10000.0, 20)


@query("""WITH v AS (SELECT c_custkey AS run, CASE WHEN c_nationkey % 4 = 0 THEN 'discordant' WHEN c_nationkey % 4 < 3 THEN 'no_discordance' END AS vote FROM customer), k AS (SELECT o_custkey AS run, count(*) FILTER (WHERE o_orderstatus <> 'P') / count(*) AS c FROM orders GROUP BY 1),
 r AS (SELECT v.run, CASE WHEN v.run % 10 = 0 THEN 'excluded' WHEN v.run % 7 = 0 THEN 'active' WHEN v.run % 5 = 0 THEN 'no_products' WHEN c IS NULL THEN 'no_completeness' WHEN c < 0.6 THEN 'below_threshold' WHEN vote = 'discordant' THEN 'discordant' WHEN vote IS NULL THEN 'no_vote' END AS reason FROM v LEFT JOIN k USING (run))
 SELECT run, CASE WHEN reason IS NULL THEN 'accept' WHEN reason IN ('excluded', 'below_threshold', 'discordant') THEN 'exclude' ELSE 'hold' END AS decision, reason FROM r""")
def run_review(spark, sf_dir):
    """JN-22: accept, exclude or hold from status tables."""
    runs = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run"), "c_nationkey")
    vote = F.when(F.col("c_nationkey") % 4 == 0, "discordant").when(F.col("c_nationkey") % 4 < 3, "no_discordance")
    full = selection.completeness(order_counts(spark, sf_dir)).withColumnRenamed("sample", "run")
    out = selection.review(runs, runs.where("run % 5 <> 0"), runs.where("run % 7 = 0"), runs.where("run % 10 = 0"), full, runs.select("run", vote.alias("decision")), 0.6)
    return out.select("run", "decision", "reason")


# --- reuse ---------------------------------------------------------------------------------------------------------

@query("""WITH d AS (SELECT doc_id AS sample, sha256(text) AS sha256 FROM documents) SELECT sample, sha256, CASE WHEN sample % 2 = 0 THEN CASE WHEN sample % 3 = 0 THEN 'early' ELSE 'late' END END AS source, CASE WHEN sample % 2 = 0 THEN 'reuse' ELSE 'missing' END AS action FROM d""")
def reuse_plan(spark, sf_dir):
    """JN-15, IO-16: reuse where an earlier snapshot holds the same content, first source by priority."""
    own = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample"), F.sha2("text", 256).alias("sha256"))
    late = own.where("sample % 2 = 0").select("sample", "sha256", F.lit(2).alias("priority"), F.lit("late").alias("source"))
    early = own.where("sample % 6 = 0").select("sample", "sha256", F.lit(1).alias("priority"), F.lit("early").alias("source"))
    return mapping.reuse_plan(own, late.union(early))


@query("SELECT sha256(text) AS sample, count(DISTINCT source) AS contents FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def reuse_conflicts(spark, sf_dir):
    """JN-16: samples that sources hold with different contents."""
    return mapping.reuse_conflicts(read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sample"), F.col("source").alias("sha256")))


# --- markers -------------------------------------------------------------------------------------------------------

FULL_SQL = """f AS (SELECT l_suppkey AS sample, l_partkey AS marker, count(*) AS n, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
 busco AS (SELECT sample, marker, CASE WHEN n > 1 THEN 'Duplicated' WHEN flag = 'A' THEN 'Complete' WHEN flag = 'N' THEN 'Fragmented' ELSE 'Missing' END AS status, marker % 50 AS sequence, unnest(range(n)) AS r FROM f)"""


def marker_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("marker")).agg(F.count("*").alias("n"), F.min("l_returnflag").alias("flag"))
    status = F.when(F.col("n") > 1, "Duplicated").when(F.col("flag") == "A", "Complete").when(F.col("flag") == "N", "Fragmented").otherwise("Missing")
    return own.select("sample", "marker", status.alias("status"), (F.col("marker") % 50).alias("sequence"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("r"))


@query(f"""WITH {FULL_SQL}, m AS (SELECT sample, marker, min(status) AS s FROM busco GROUP BY ALL) SELECT sample, count(*) FILTER (WHERE s = 'Complete') AS single, count(*) FILTER (WHERE s = 'Duplicated') AS duplicated, count(*) FILTER (WHERE s = 'Fragmented') AS fragmented, count(*) FILTER (WHERE s = 'Missing') AS missing, count(*) AS total, 0 AS repeated FROM m GROUP BY 1""")
def marker_counts(spark, sf_dir):
    """AG-10: completeness counts from the full table."""
    return markers.completeness_counts(marker_table(spark, sf_dir))


SINGLE_SQL = f"""WITH {FULL_SQL}, one AS (SELECT sample, marker, sequence FROM busco WHERE status = 'Complete' QUALIFY count(*) OVER (PARTITION BY sample, sequence) = 1)"""


@query(f"{SINGLE_SQL} SELECT * FROM one")
def single_copies(spark, sf_dir):
    """AG-11: single-copy hits without sequences shared by markers."""
    return markers.single_copy(marker_table(spark, sf_dir)).select("sample", "marker", "sequence")


COVER_SQL = f"""{SINGLE_SQL}, s AS (SELECT DISTINCT s_suppkey AS sample, s_nationkey AS sp FROM supplier), t AS (SELECT count(DISTINCT sp) AS total FROM s),
 c AS (SELECT marker, count(DISTINCT sp) AS species, count(DISTINCT sample) AS samples, avg(CAST(p_size AS DOUBLE)) AS mean_length FROM one JOIN s USING (sample) JOIN part ON p_partkey = marker GROUP BY 1),
 k AS (SELECT p_partkey AS marker, coalesce(species, 0) AS species, coalesce(samples, 0) AS samples, mean_length, coalesce(species, 0) / total AS occupancy, coalesce(species, 0) >= ceil(CAST('0.05' AS DECIMAL(10,4)) * total) AS eligible FROM part LEFT JOIN c ON c.marker = p_partkey, t)"""


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("marker"), F.col("p_size").cast("double").alias("length"))
    samples = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample"), F.col("s_nationkey").alias("species_id"))
    return markers.marker_coverage(markers.single_copy(marker_table(spark, sf_dir)).join(part, "marker"), part, samples, "0.05")


@query(f"{COVER_SQL} SELECT marker, species, samples, round(mean_length, 6) AS mean_length, round(occupancy, 9) AS occupancy, eligible, CASE WHEN eligible THEN row_number() OVER (PARTITION BY eligible ORDER BY species DESC, marker) END AS place FROM k")
def marker_coverage(spark, sf_dir):
    """AG-12, WN-03: coverage, occupancy and rank of markers."""
    return coverage(spark, sf_dir).withColumns({"mean_length": F.round("mean_length", 6), "occupancy": F.round("occupancy", 9)})


@query(f"{COVER_SQL} SELECT marker, species FROM k WHERE eligible ORDER BY species DESC, marker LIMIT 20")
def best_markers(spark, sf_dir):
    """WN-03, ST-03: top markers."""
    return markers.best_markers(coverage(spark, sf_dir), 20).select("marker", "species")


@query(f"{SINGLE_SQL} SELECT trees, count(*) AS samples FROM (SELECT s_suppkey, count(DISTINCT marker) AS trees FROM supplier LEFT JOIN one ON sample = s_suppkey GROUP BY 1) GROUP BY 1")
def tree_coverage(spark, sf_dir):
    """AG-13: trees per sample with zeros, and their distribution."""
    own = markers.single_copy(marker_table(spark, sf_dir)).select("sample", F.col("marker").alias("tree_id"))
    return markers.coverage_distribution(markers.gene_tree_coverage(own, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample"))))


@query(f"""{SINGLE_SQL}, t AS (SELECT p_partkey AS tree_id, p_size AS sites, CASE WHEN p_size % 3 = 0 THEN 'too_few' ELSE 'retained' END AS status FROM part), k AS (SELECT * FROM t WHERE status = 'retained'), s AS (SELECT DISTINCT sample FROM one JOIN k ON k.tree_id = marker), o AS (SELECT s_suppkey AS sample FROM supplier WHERE s_suppkey % 8 > 0 UNION ALL SELECT -s_suppkey FROM supplier WHERE s_suppkey % 20 = 1)
 SELECT (SELECT count(*) FROM k) AS retained, (SELECT count(*) FROM t) - (SELECT count(*) FROM k) AS excluded, (SELECT CAST(sum(sites) AS BIGINT) FROM k) AS total_sites, (SELECT round(avg(sites), 6) FROM k) AS mean_sites, (SELECT count(*) FROM o) AS samples,
 (SELECT count(*) FROM o WHERE sample NOT IN (SELECT sample FROM s)) AS unrepresented, (SELECT count(*) FROM s WHERE sample NOT IN (SELECT sample FROM o)) AS unexpected, 'insufficient_coverage' AS status""")
def gene_tree_summary(spark, sf_dir):
    """AG-13: sites of retained gene trees, samples that none holds and tips that are no samples."""
    trees = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("tree_id"), F.col("p_size").cast("long").alias("sites"), F.when(F.col("p_size") % 3 == 0, "too_few").otherwise("retained").alias("status"))
    tips = markers.single_copy(marker_table(spark, sf_dir)).select("sample", F.col("marker").alias("tree_id"))
    k = F.col("s_suppkey")
    own = read(spark, sf_dir, "supplier")
    samples = own.where(k % 8 > 0).select(k.alias("sample")).union(own.where(k % 20 == 1).select(-k))
    return markers.gene_tree_summary(trees, tips, samples).withColumn("mean_sites", F.round("mean_sites", 6))


@query("""WITH e AS (SELECT label AS marker, unnest(range(len(embedding))) AS col, unnest(list_transform(embedding, lambda x: CASE WHEN x < -0.1 THEN 'A' WHEN x < 0 THEN 'C' WHEN x < 0.1 THEN '-' ELSE 'T' END)) AS aa FROM embeddings),
 r AS (SELECT marker, col, aa, count(*) AS n FROM e GROUP BY ALL), c AS (SELECT marker, col, count(*) FILTER (WHERE aa <> '-') AS x, count(*) FILTER (WHERE aa <> '-' AND n >= 2) AS y FROM r GROUP BY ALL)
 SELECT c.marker, any_value(k.n) AS rows, count(*) AS columns, count(*) FILTER (WHERE x >= 2) AS variable_sites, count(*) FILTER (WHERE y >= 2) AS informative_sites FROM c JOIN (SELECT label AS marker, count(*) AS n FROM embeddings GROUP BY 1) k USING (marker) GROUP BY 1""")
def alignment_sites(spark, sf_dir):
    """AG-14, FN-10: variable and informative columns."""
    letter = lambda x: F.when(x < -0.1, "A").when(x < 0, "C").when(x < 0.1, "-").otherwise("T")
    own = read(spark, sf_dir, "embeddings").select(F.col("label").alias("marker"), F.array_join(F.transform("embedding", letter), "").alias("seq"))
    return markers.alignment_sites(own)


@query("""WITH s AS (SELECT l_partkey AS marker, l_suppkey AS organism, l_suppkey % 40 AS species, l_suppkey % 3 = 0 AS sub, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) = 1), b AS (SELECT species, organism, sub, count(*) AS m FROM s GROUP BY species, organism, sub), c AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY m DESC, sub, organism) AS k FROM b)
 SELECT s.marker, s.organism, s.species FROM s JOIN c USING (species, organism) WHERE k = 1""")
def reference_panel(spark, sf_dir):
    """AG-16: one protein per marker and organism, best organism per species."""
    own = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("marker"), F.col("l_suppkey").alias("organism"), (F.col("l_suppkey") % 40).alias("species"), (F.col("l_suppkey") % 3 == 0).alias("is_subspecies"))
    return markers.reference_panel(own)


@query("SELECT lang AS run, source AS locus, min(text) AS seq FROM (SELECT lang, source || '/' || CAST(doc_id % 500 AS VARCHAR) AS source, text FROM documents) GROUP BY ALL HAVING count(DISTINCT text) = 1 AND length(min(text)) >= 150")
def recovered_loci(spark, sf_dir):
    """AG-17: loci with one distinct sequence, long enough."""
    own = read(spark, sf_dir, "documents").select(F.col("lang").alias("run"), F.concat_ws("/", "source", (F.col("doc_id") % 500).cast("string")).alias("locus"), F.col("text").alias("seq"))
    return markers.recovered_loci(own)


# --- votes: user, hour, event type ----------------------------------------------------------------------------------

VOTES_SQL = """h AS (SELECT user_id AS run, CASE WHEN event_id % 2 = 0 THEN 'genus' ELSE 'family' END AS rank, extract(hour FROM ts) AS locus, event_type AS taxon, max(value) AS score FROM events GROUP BY ALL),
 top AS (SELECT run, rank, locus, taxon, floor(score / 10) AS s FROM h), m AS (SELECT run, rank, locus, max(s) AS m FROM top GROUP BY ALL), w AS (SELECT t.* FROM top t JOIN m USING (run, rank, locus) WHERE t.s = m.m),
 v AS (SELECT run, rank, locus, bool_or(taxon = 'view') AS reg, list_sort(list(taxon) FILTER (WHERE taxon <> 'view')) AS winners FROM w GROUP BY ALL),
 votes AS (SELECT run, rank, locus, CASE WHEN reg AND winners IS NULL THEN 'registered' WHEN reg THEN 'tie' ELSE 'alternative' END AS vote, winners FROM v)"""
SUMMARY_SQL = """q AS (SELECT run, rank, vote, winners, CASE WHEN vote IN ('alternative', 'tie') THEN 720720 // (len(winners) + CASE WHEN vote = 'tie' THEN 1 ELSE 0 END) END AS share FROM votes),
 tot AS (SELECT run, rank, count(*) AS comparable_loci, sum(CASE WHEN vote = 'registered' THEN 720720 WHEN vote = 'tie' THEN share ELSE 0 END) AS mine, count(*) FILTER (WHERE vote = 'tie') AS tied_loci FROM q GROUP BY ALL),
 alts AS (SELECT run, rank, a, sum(share) AS s FROM (SELECT run, rank, unnest(winners) AS a, share FROM q WHERE share IS NOT NULL) GROUP BY run, rank, a), alt AS (SELECT * FROM alts QUALIFY row_number() OVER (PARTITION BY run, rank ORDER BY s DESC, a) = 1),
 summary AS (SELECT run, rank, CASE WHEN comparable_loci < 5 THEN 'insufficient_comparison' WHEN mine * 4 < comparable_loci * 720720 THEN 'discordant' ELSE 'no_discordance' END AS status, comparable_loci, round(mine / 720720, 6) AS registered_votes, tied_loci, a AS alternative, round(coalesce(s, 0) / 720720, 6) AS alternative_votes FROM tot LEFT JOIN alt USING (run, rank))"""


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "events")
    return own.groupBy(F.col("user_id").alias("run"), F.when(F.col("event_id") % 2 == 0, "genus").otherwise("family").alias("rank"), F.hour("ts").alias("locus"), F.col("event_type").alias("taxon")).agg(F.max("value").alias("score"))


def event_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole locus vote with one position per unit of score: all scores are equal, so all alternatives compete."""
    s = F.floor(F.col("score") / 10).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.lit(199)), lambda i: F.struct(i.alias("pos"), (i < s).alias("ok")))
    own = event_hits(spark, sf_dir).withColumn("matched", places)
    own = own.select("run", "rank", "locus", F.lit(200).alias("length"), F.lit("view").alias("registered"), "taxon", F.lit(1).alias("score"), "matched")
    return votes.locus_votes(own)


@query(f"""WITH {VOTES_SQL.split(' top AS')[0].rstrip().rstrip(',')}, t AS (SELECT run, rank, locus, taxon, least(greatest(CAST(floor(score / 10) AS INTEGER), 0), 200) AS s FROM h),
 g AS (SELECT run, rank, locus, max(s) FILTER (WHERE taxon = 'view') AS old, max(s) FILTER (WHERE taxon <> 'view') AS new, count(*) FILTER (WHERE taxon = 'view') AS r, count(*) FILTER (WHERE taxon <> 'view') AS a FROM t GROUP BY ALL)
 SELECT run, rank, locus, CASE WHEN r = 0 THEN 'no_registered_hit' WHEN a = 0 THEN 'no_alternative_hit' WHEN old > new THEN 'registered' WHEN old < new THEN 'alternative' ELSE 'tie' END AS vote,
 CASE WHEN r > 0 AND a > 0 AND old <= new THEN (SELECT string_agg(taxon, ',' ORDER BY taxon) FROM t WHERE t.run = g.run AND t.rank = g.rank AND t.locus = g.locus AND t.taxon <> 'view' AND t.s = g.new) END AS winners FROM g""")
def locus_votes(spark, sf_dir):
    """WN-05: registered taxon against the best alternatives, locus by locus."""
    return event_votes(spark, sf_dir).select("run", "rank", "locus", "vote", F.array_join("winners", ",").alias("winners"))


def vote_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = event_hits(spark, sf_dir).withColumn("s", F.floor(F.col("score") / 10))
    best = top.groupBy("run", "rank", "locus").agg(F.max("s").alias("s"))
    won = top.join(best, ["run", "rank", "locus", "s"]).groupBy("run", "rank", "locus").agg(F.bool_or(F.col("taxon") == "view").alias("reg"), F.array_sort(F.collect_list(F.when(F.col("taxon") != "view", F.col("taxon")))).alias("winners"))
    vote = F.when(F.col("reg") & (F.size("winners") == 0), "registered").when(F.col("reg"), "tie").otherwise("alternative")
    return won.select("run", "rank", "locus", vote.alias("vote"), "winners")


def summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_summary(vote_table(spark, sf_dir), 5, "0.25")


@query(f"WITH {VOTES_SQL}, {SUMMARY_SQL} SELECT * FROM summary")
def vote_summary(spark, sf_dir):
    """AG-15, AG-18: exact shares, leading alternative and decision per run and rank."""
    out = summary_table(spark, sf_dir)
    return out.select("run", "rank", "status", "comparable_loci", F.round("registered_votes", 6).alias("registered_votes"), "tied_loci", "alternative", F.round("alternative_votes", 6).alias("alternative_votes"))


@query(f"WITH {VOTES_SQL}, {SUMMARY_SQL}, p AS (SELECT *, CASE rank WHEN 'genus' THEN 0 ELSE 1 END AS o FROM summary), d AS (SELECT run, coalesce(min(o) FILTER (WHERE comparable_loci >= 24), max(o)) AS o FROM p GROUP BY 1) SELECT run, rank, status, comparable_loci FROM p JOIN d USING (run, o)")
def deciding_rank(spark, sf_dir):
    """WN-06: first rank with enough loci decides."""
    out = summary_table(spark, sf_dir)
    return votes.deciding_rank(out, out.select("run"), ["genus", "family"], 24).select("run", "rank", "status", "comparable_loci")


@query("""SELECT user_id AS query, CASE WHEN event_id % 3 = 0 THEN 'genus' ELSE 'family' END AS rank, event_type AS taxon, arg_min(event_id, struct_pack(a := -value, b := event_id)) AS target, max(value) AS raw FROM events GROUP BY ALL""")
def best_hits(spark, sf_dir):
    """WN-04: best hit per query, rank and taxon."""
    own = read(spark, sf_dir, "events").select(F.col("event_id").alias("target"), F.col("user_id").alias("query"), F.col("value").alias("raw"))
    taxa = read(spark, sf_dir, "events").select(F.col("event_id").alias("target"), F.when(F.col("event_id") % 3 == 0, "genus").otherwise("family").alias("rank"), F.col("event_type").alias("taxon"))
    return votes.best_hits(own, taxa).select("query", "rank", "taxon", "target", "raw")


# --- identities and text functions -----------------------------------------------------------------------------------

@query("""SELECT c_custkey, replace(c_name || ' sp-' || CAST(c_nationkey AS VARCHAR), ' ', '_') AS species_id, replace(c_name || ' sp-' || CAST(c_nationkey AS VARCHAR), ' ', '_') || '_R_' || CAST(c_custkey AS VARCHAR) AS analysis_sample_id,
 replace(replace(c_name || ' sp-' || CAST(c_nationkey AS VARCHAR), ' ', '_') || '_R_' || CAST(c_custkey AS VARCHAR), '-', '_') AS odb_species, CAST(NULL AS VARCHAR) AS conflict FROM customer""")
def sample_identities(spark, sf_dir):
    """PR-01: identities from name and run."""
    own = read(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(" sp-"), text("c_nationkey")).alias("scientific_name"), F.concat(F.lit("R_"), text("c_custkey")).alias("run"))
    return identity.annotate_samples(own).drop("scientific_name", "run")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'S' || CAST(c_custkey AS VARCHAR) || '_R_1' END AS sample, c_custkey % 3 <> 2 AS safe FROM customer")
def gene_samples(spark, sf_dir):
    """PR-02, PR-06: sample of a gene id, safe identifiers."""
    k = text("c_custkey")
    gene = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("S"), k, F.lit("_R_1_g"), k)).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("S"), k)).otherwise(F.concat(F.lit("-S_g"), k))
    return read(spark, sf_dir, "customer").select("c_custkey", T.sample_of_gene(gene).alias("sample"), T.is_safe(gene).alias("safe"))


@query("""WITH x AS (SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace('[' || c_mktsegment || ']  (' || c_name || ')/a', '[\\[\\](){}'',"]', '', 'g'), '[:/#]', '-', 'g'), '\\s+', ' ', 'g')) AS n FROM customer)
 SELECT c_custkey, CASE WHEN contains(n, ' ') OR n = '' THEN n ELSE n || '_XXX' END AS name FROM x""")
def clean_names(spark, sf_dir):
    """PR-03: scientific-name clean-up."""
    raw = F.concat(F.lit("["), "c_mktsegment", F.lit("]  ("), "c_name", F.lit(")/a"))
    return read(spark, sf_dir, "customer").select("c_custkey", T.clean_scientific_name(raw).alias("name"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 AND c_custkey > 0 THEN c_custkey END AS taxid, CASE WHEN c_custkey % 4 = 3 OR (c_custkey = 0) THEN 'taxid' END AS bad FROM customer")
def canonical_taxids(spark, sf_dir):
    """PR-04: 42 and 42.0 are 42, blank is null, the rest is bad."""
    k, m = text("c_custkey"), F.col("c_custkey") % 4
    raw = F.when(m == 0, k).when(m == 1, F.concat(k, F.lit(".0"))).when(m == 2, "").otherwise(F.concat(k, F.lit(".5")))
    return identity.canonical_taxids(read(spark, sf_dir, "customer").select("c_custkey", raw.alias("taxid")), ["taxid"])


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_totalprice WHEN 4 THEN o_orderkey * 10.0 END AS v FROM orders")
def numeric_text(spark, sf_dir):
    """PR-07: numbers held as text; 1d, inf and negative ones aren't."""
    m, k = F.col("o_orderkey") % 5, text("o_orderkey")
    raw = F.when(m == 0, text("o_totalprice")).when(m == 1, F.concat(k, F.lit("d"))).when(m == 2, "inf").when(m == 3, F.concat(F.lit("-1"), k)).otherwise(F.concat(k, F.lit("e1")))
    return read(spark, sf_dir, "orders").select("o_orderkey", T.number(raw).alias("v"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) END AS fresh, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'fresh' END AS conflict FROM customer")
def coalesced_aliases(spark, sf_dir):
    """PR-08: legacy columns coalesced, conflicts named."""
    own = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("fresh"), F.when(F.col("c_custkey") % 2 == 1, text("c_nationkey")).when(F.col("c_custkey") % 3 == 0, "other").alias("legacy"))
    return identity.coalesce_aliases(own, {"fresh": "legacy"})


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 2 = 0 THEN 'N' || CAST(l_suppkey AS VARCHAR) ELSE 'S' || CAST(l_suppkey AS VARCHAR) END || '_g' || CAST(l_partkey AS VARCHAR) AS gene_id FROM lineitem")
def relabelled_genes(spark, sf_dir):
    """PR-10: gene ids re-keyed from one sample to another."""
    own = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("S"), text("l_suppkey"), F.lit("_g"), text("l_partkey")).alias("gene_id"))
    names = read(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("S"), text("s_suppkey")).alias("old"), F.concat(F.lit("N"), text("s_suppkey")).alias("new"))
    return identity.relabel_genes(own, names)


@query("SELECT CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'F' WHEN o_orderkey % 3 = 0 THEN 'unknown' WHEN o_orderstatus = 'F' THEN 'F' ELSE 'mixed' END AS evidence, count(*) AS n FROM orders GROUP BY 1")
def read_evidence(spark, sf_dir):
    """PR-20: two stages to one value."""
    k = F.col("o_orderkey")
    second = F.when((F.col("o_orderstatus") == "F") & (k % 2 == 0), "F").when(k % 3 == 0, "").otherwise(F.lit("F"))
    return selection.count_by(identity.read_evidence(read(spark, sf_dir, "orders").select("o_orderstatus", second.alias("second")), "o_orderstatus", "second"), "evidence")


@query("""WITH r AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) SELECT 'bad' AS rule, CAST(count(*) FILTER (WHERE o_totalprice < 2000) AS BIGINT) AS n FROM orders UNION ALL SELECT 'odd', count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM orders""")
def counted_violations(spark, sf_dir):
    """PR-18: all row rules counted in one pass."""
    out = checks.count_violations(read(spark, sf_dir, "orders"), {"bad": F.col("o_totalprice") < 2000, "odd": ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")})
    return out.select(F.explode(F.map_from_arrays(F.array(F.lit("bad"), F.lit("odd")), F.array("bad", "odd"))).alias("rule", "n"))


@query("SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    """PR-18: unique-key check."""
    return checks.check_unique(read(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"])


@query("SELECT l_partkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def several_values(spark, sf_dir):
    """PR-18: one-value-per-key check."""
    return checks.check_functional(read(spark, sf_dir, "lineitem"), ["l_partkey"], "l_returnflag")


@query("SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def unmatched_keys(spark, sf_dir):
    """PR-18: foreign-key check."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return checks.check_foreign_key(orders, read(spark, sf_dir, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("k")), ["k"])


@query("""WITH a AS (SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN -o_custkey - 1 ELSE o_custkey END AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer)
 SELECT k, 'extra' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'missing' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def coverage_check(spark, sf_dir):
    """SO-02, SO-03: keys missing or extra."""
    a = read(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("k"))
    return checks.check_coverage(a, read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), ["k"])


EXPR_SQL = """x AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS sample, CASE WHEN l_linenumber = 7 THEN 'T1' ELSE 'S' || CAST(l_suppkey AS VARCHAR) END || '_g' || CAST(l_partkey AS VARCHAR) AS gene, CASE WHEN l_quantity = 1 THEN -1.0 ELSE l_quantity END AS v FROM lineitem)"""


@query(f"""WITH {EXPR_SQL}, r AS (SELECT 'bad value' AS rule, sample FROM x WHERE v < 0 UNION ALL SELECT 'foreign gene', sample FROM x WHERE gene NOT LIKE sample || '\\_g%' ESCAPE '\\' UNION ALL SELECT 'repeated', sample FROM (SELECT sample, gene FROM x GROUP BY ALL HAVING count(*) > 1)
 UNION ALL SELECT 'missing sample', 'S' || CAST(s_suppkey + 1000000 AS VARCHAR) FROM supplier WHERE s_suppkey % 10 = 0) SELECT rule, sample, count(*) AS n FROM r GROUP BY ALL""")
def expression_check(spark, sf_dir):
    """PR-19: all rules of an expression table."""
    k = F.concat(F.lit("S"), text("l_suppkey"))
    gene = F.concat(F.when(F.col("l_linenumber") == 7, F.lit("T1")).otherwise(k), F.lit("_g"), text("l_partkey"))
    own = read(spark, sf_dir, "lineitem").select(k.alias("sample"), gene.alias("gene_id"), F.when(F.col("l_quantity") == 1, -1.0).otherwise(F.col("l_quantity")).alias("tpm"))
    more = read(spark, sf_dir, "supplier").where("s_suppkey % 10 = 0").select(F.concat(F.lit("S"), (F.col("s_suppkey") + 1000000).cast("string")).alias("sample"))
    return checks.check_expression(own, own.select("sample").distinct().union(more)).groupBy("rule", "sample").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, list_sort(list_distinct(regexp_extract_all(note, '[DES]RR[0-9]+'))) AS acc, CAST(ceil(CAST('0.07' AS DECIMAL(20,12)) * p_size) AS BIGINT) AS cut
 FROM (SELECT p_partkey, p_size, translate(p_name || p_brand, 'abcdefghijklmnopqrstuvwxyz#B0123456789 ', 'ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT') AS seq, 'SRR' || CAST(p_partkey AS VARCHAR) || ' x ERR' || CAST(p_size AS VARCHAR) AS note FROM part)""")
def sequence_functions(spark, sf_dir):
    """FN-05, FN-07, FN-11: reverse complement, accession tokens, decimal ceiling."""
    seq = F.translate(F.concat("p_name", "p_brand"), "abcdefghijklmnopqrstuvwxyz#B0123456789 ", "ACGT" * 10)
    note = F.concat(F.lit("SRR"), text("p_partkey"), F.lit(" x ERR"), text("p_size"))
    return read(spark, sf_dir, "part").select("p_partkey", T.reverse_complement(seq).alias("rc"), F.array_sort(T.accessions(note)).alias("acc"), T.decimal_ceiling("0.07", F.col("p_size")).alias("cut"))


@query("""SELECT page_id, CASE WHEN q = '' THEN NULL ELSE nullif(regexp_extract(q, '(?:^|&)ref=([^&#]*)', 1), '') END AS ref, nullif(regexp_extract(q, '(?:^|&)page=([^&#]*)', 1), '') AS page FROM (SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages)""")
def header_words(spark, sf_dir):
    """FN-01, FN-12: key=value words as a map."""
    q = T.header_words(F.regexp_extract("url", r"\?([^#]*)", 1), "&", "=")
    return read(spark, sf_dir, "pages").select("page_id", F.try_element_at(q, F.lit("ref")).alias("ref"), F.try_element_at(q, F.lit("page")).alias("page"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS labels FROM orders GROUP BY 1")
def joined_labels(spark, sf_dir):
    """FN-15: distinct values sorted in one text."""
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(T.joined_sorted("o_orderpriority").alias("labels"))


@query("SELECT c_custkey, sha256('{\"c_custkey\":' || CAST(c_custkey AS VARCHAR) || ',\"c_mktsegment\":\"' || c_mktsegment || '\"}') AS digest FROM customer")
def row_digests(spark, sf_dir):
    """FN-04, FN-14: SHA-256 of canonical JSON."""
    return read(spark, sf_dir, "customer").select("c_custkey", T.digest("c_custkey", "c_mktsegment").alias("digest"))


@query("""WITH c AS (SELECT o_custkey AS sample, count(*) FILTER (WHERE o_orderstatus <> 'P') AS p, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT sample, 10000 * p // n + CASE WHEN 2 * (10000 * p % n) > n OR (2 * (10000 * p % n) = n AND 10000 * p // n % 2 = 1) THEN 1 ELSE 0 END AS bp FROM c)
 SELECT sample, printf('%d.%02d', bp // 100, bp % 100) AS completeness_percent, 'v' || CAST(sample % 3 AS VARCHAR) AS version, CASE sample % 4 WHEN 0 THEN 'Flowering plants' WHEN 1 THEN 'Ferns' WHEN 2 THEN 'c2' END AS clade_label FROM b""")
def processing_summary(spark, sf_dir):
    """AG-25, FN-05: percent with two places, the tool's version, and the clade's label, or its own name where it has none."""
    clade = F.when(F.col("sample") % 4 < 3, F.concat(F.lit("c"), (F.col("sample") % 4).cast("string")))
    own = order_counts(spark, sf_dir).withColumn("clade", clade).withColumn("version", F.concat(F.lit("v"), (F.col("sample") % 3).cast("string")))
    out = subset.processing_summary(own, labels={"c0": "Flowering plants", "c1": "Ferns"})
    return out.select("sample", F.translate("completeness_percent", ",", "").alias("completeness_percent"), "version", "clade_label")


# --- taxonomy: customer -> nation -> region -------------------------------------------------------------------------

NODES_SQL = """nodes AS (SELECT 1 AS taxid, 1 AS parent, 'no rank' AS rank, 'root' AS name UNION ALL SELECT 10 + r_regionkey, 1, 'order', r_name FROM region UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'family', n_name FROM nation UNION ALL SELECT 1000 + c_custkey, 100 + c_nationkey, 'species', c_name FROM customer),
 up AS (SELECT taxid, 0 AS depth, taxid AS anc, rank, name FROM nodes WHERE rank = 'species' UNION ALL SELECT c.taxid, 1, n.taxid, n.rank, n.name FROM nodes c JOIN nodes n ON c.parent = n.taxid WHERE c.rank = 'species'
 UNION ALL SELECT c.taxid, 2, r.taxid, r.rank, r.name FROM nodes c JOIN nodes n ON c.parent = n.taxid JOIN nodes r ON n.parent = r.taxid WHERE c.rank = 'species' UNION ALL SELECT taxid, 3, 1, 'no rank', 'root' FROM nodes WHERE rank = 'species')"""


def tax_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda df, i, p, rank, name: df.select(F.expr(i).cast("long").alias("taxid"), F.expr(p).cast("long").alias("parent"), F.lit(rank).alias("rank"), F.expr(name).alias("name"))
    root = n(read(spark, sf_dir, "region").limit(1), "1", "1", "no rank", "'root'")
    out = root.union(n(read(spark, sf_dir, "region"), "10 + r_regionkey", "1", "order", "r_name"))
    out = out.union(n(read(spark, sf_dir, "nation"), "100 + n_nationkey", "10 + n_regionkey", "family", "n_name"))
    return out.union(n(read(spark, sf_dir, "customer"), "1000 + c_custkey", "100 + c_nationkey", "species", "c_name"))


def tax_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tax_nodes(spark, sf_dir)
    return taxonomy.lineages(nodes, nodes.where("rank = 'species'"))


@query(f"WITH {NODES_SQL} SELECT * FROM up")
def lineages(spark, sf_dir):
    """JN-12, IO-09: lineage of every taxon by recursion over parent links."""
    return tax_lineage(spark, sf_dir)


@query(f"WITH {NODES_SQL} SELECT taxid, max(name) FILTER (WHERE rank = 'family') AS family, max(anc) FILTER (WHERE rank = 'family') AS family_taxid, max(name) FILTER (WHERE rank = 'order') AS \"order\", max(anc) FILTER (WHERE rank = 'order') AS order_taxid FROM up GROUP BY 1")
def rank_columns(spark, sf_dir):
    """JN-02, JN-12: one column per rank."""
    return taxonomy.ranks(tax_lineage(spark, sf_dir), ["family", "order"])


@query(f"WITH {NODES_SQL} SELECT t AS taxid, CASE WHEN t % 5 = 0 THEN 1000 + t % 40 WHEN t % 5 < 4 THEN t END AS resolved_taxid FROM (SELECT 1000 + c_custkey AS t FROM customer)")
def resolved_taxids(spark, sf_dir):
    """JN-12, JN-13: redirects followed; cycles and unknown ids are null."""
    ids = read(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000).alias("taxid"))
    alive = tax_nodes(spark, sf_dir).where("rank = 'species' and taxid % 5 < 4 and taxid % 5 > 0 or taxid < 1040")
    hop = ids.where("taxid % 5 = 0").select(F.col("taxid").alias("taxid_old"), (-F.col("taxid")).alias("taxid_new"))
    last = ids.where("taxid % 5 = 0").select((-F.col("taxid")).alias("taxid_old"), (1000 + F.col("taxid") % 40).alias("taxid_new"))
    cycle = ids.where("taxid % 5 = 4").select(F.col("taxid").alias("taxid_old"), F.col("taxid").alias("taxid_new"))
    far = hop.union(last.where("taxid_old <> -taxid_new"))
    loops = hop.join(last.where("taxid_old = -taxid_new").select(F.col("taxid_old").alias("taxid_new")), "taxid_new", "left_semi").select("taxid_old", "taxid_new")
    return taxonomy.resolve_merged(ids, far.join(loops, ["taxid_old", "taxid_new"], "left_anti").union(cycle), alive).select("taxid", "resolved_taxid")


@query("""SELECT c_custkey AS taxid, CASE WHEN k % 7 < 5 THEN c_custkey - c_custkey % 60 + 59 END AS resolved_taxid, CASE WHEN k % 7 = 5 THEN 'cycle' WHEN k % 7 = 6 THEN 'unknown' END AS reason FROM (SELECT c_custkey, c_custkey // 60 AS k FROM customer)""")
def redirect_chains(spark, sf_dir):
    """JN-12, JN-13: redirects in chains of up to 59 hops, in circles of 60, and to ids that are no nodes."""
    k = F.col("c_custkey")
    own = read(spark, sf_dir, "customer").select(k.alias("taxid"), F.floor(k / 60).alias("chain")).hint("merge")
    last = F.col("taxid") % 60 == 59
    # every chain goes on to its end, whether or not the table has all of its ids
    links = own.select("chain").distinct().select("chain", F.explode(F.sequence(F.col("chain") * 60, F.col("chain") * 60 + 59)).alias("taxid"))
    links = links.where(~last | (F.col("chain") % 7 == 5)).select(F.col("taxid").alias("taxid_old"), F.when(last, F.col("taxid") - 59).otherwise(F.col("taxid") + 1).alias("taxid_new"))
    nodes = own.where("chain % 7 <> 6").select((F.col("chain") * 60 + 59).alias("taxid"))
    return taxonomy.resolve_merged(own, links, nodes)


@query(f"""WITH {NODES_SQL} SELECT taxid, CASE WHEN parent % 7 = 3 THEN 'incomplete' ELSE 'cycle' END AS problem FROM nodes WHERE rank = 'species' AND parent % 7 IN (3, 5)
 UNION ALL SELECT -taxid, 'unknown' FROM nodes WHERE rank = 'species' AND parent % 7 < 3""")
def lineage_problems(spark, sf_dir):
    """JN-12, IO-09: taxa whose family is no node, whose family goes round in a circle, and ids that are no taxa."""
    nodes = tax_nodes(spark, sf_dir)
    family = F.col("rank") == "family"
    odd = nodes.where(family & (F.col("taxid") % 7 == 5))
    back = odd.select((-F.col("taxid")).alias("taxid"), F.col("taxid").alias("parent"), "rank", "name")
    broken = nodes.where(~family | (F.col("taxid") % 7 != 3)).withColumn("parent", F.when(family & (F.col("taxid") % 7 == 5), -F.col("taxid")).otherwise(F.col("parent")))
    ids = nodes.where("rank = 'species'").select("taxid")
    unknown = nodes.where("rank = 'species' and parent % 7 < 3").select((-F.col("taxid")).alias("taxid"))
    return taxonomy.lineage_problems(broken.unionByName(back), ids.union(unknown))


@query("SELECT k AS taxid, CAST(d AS INTEGER) AS depth, k >> d AS anc FROM (SELECT c_custkey AS k, unnest(range(length(bin(c_custkey)))) AS d FROM customer WHERE c_custkey > 0)")
def deep_lineages(spark, sf_dir):
    """JN-12: lineages of every depth, a taxon's parent being half its number."""
    k = F.col("c_custkey")
    ids = read(spark, sf_dir, "customer").where("c_custkey > 0").select(k.alias("taxid"))
    nodes = ids.select(F.explode(F.transform(F.sequence(F.lit(0), F.length(F.bin("taxid")) - 1), lambda d: F.call_function("shiftright", F.col("taxid"), d.cast("int")))).alias("taxid")).distinct()
    nodes = nodes.select("taxid", F.greatest(F.lit(1).cast("long"), F.shiftright("taxid", 1)).alias("parent"), F.lit("r").alias("rank"), text("taxid").alias("name"))
    return taxonomy.lineages(nodes, ids).select("taxid", "depth", "anc")


@query(f"""WITH {NODES_SQL}, g AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE o_orderkey // 2 END AS grp, 1000 + o_custkey AS taxid FROM orders GROUP BY ALL), m AS (SELECT grp, anc, max(3 - depth) AS lvl, count(*) AS n FROM g JOIN up USING (taxid) GROUP BY ALL), s AS (SELECT grp, count(*) AS k FROM g GROUP BY 1)
 SELECT grp, arg_max(anc, lvl) AS anc FROM m JOIN s USING (grp) WHERE n = k GROUP BY 1""")
def common_ancestors(spark, sf_dir):
    """TR-02: lowest common ancestor of groups of taxa; one group holds a fifth of all."""
    grp = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(-1)).otherwise(F.floor(F.col("o_orderkey") / 2))
    g = read(spark, sf_dir, "orders").select(grp.alias("grp"), (F.col("o_custkey") + 1000).alias("taxid"))
    return taxonomy.common_ancestor(tax_lineage(spark, sf_dir), g)


@query(f"WITH {NODES_SQL}, r AS (SELECT taxid FROM nodes WHERE rank = 'species' AND taxid % 40 = 0), c AS (SELECT anc, count(DISTINCT taxid) AS n FROM up JOIN r USING (taxid) GROUP BY 1), u AS (SELECT up.taxid, up.rank, up.depth, c.n - CASE WHEN up.taxid % 40 = 0 THEN 1 ELSE 0 END AS n FROM up JOIN c USING (anc) WHERE up.rank IN ('family', 'order')) SELECT taxid, arg_min(rank, depth) AS rank FROM u WHERE n > 0 GROUP BY 1")
def nearest_reference_rank(spark, sf_dir):
    """WN-07: nearest ancestor rank with a usable reference."""
    refs = tax_nodes(spark, sf_dir).where("rank = 'species' and taxid % 40 = 0")
    return taxonomy.nearest_reference_rank(tax_lineage(spark, sf_dir), refs, ["family", "order"])


# --- sums over the whole range of doubles ---------------------------------------------------------------------------

@query("""WITH v AS (SELECT l_suppkey AS sample, CAST(l_quantity AS BIGINT) AS q, l_linenumber AS n FROM lineitem)
 SELECT sample, CAST(sum(CASE WHEN n % 2 = 0 THEN q ELSE 0 END) AS DOUBLE) AS total, CAST(NULL AS VARCHAR) AS problem FROM v GROUP BY 1""")
def wide_range_sums(spark, sf_dir):
    """FN-02: exact sums of values that cancel at 1e300 and 1e21, with small ones that must stay."""
    v = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("n"))
    parts = F.array(F.col("q") * 1e300, F.when(F.col("n") % 2 == 0, F.col("q")).otherwise(0.0), F.col("q") * -1e300, F.lit(1e21) * F.col("n"), F.lit(5e-324), F.lit(-1e21) * F.col("n"), F.lit(-5e-324))
    return sums.exact_sums(v.select("sample", F.explode(parts).alias("x")), "x", ["sample"])


@query("""SELECT l_orderkey % 5 AS kind, NULL::DOUBLE AS total, CASE WHEN l_orderkey % 5 < 3 THEN 'not_finite' ELSE 'overflow' END AS problem FROM lineitem WHERE l_orderkey % 5 < 4 GROUP BY ALL
 UNION ALL SELECT 4, CAST(count(*) AS DOUBLE), NULL FROM lineitem WHERE l_orderkey % 5 = 4 HAVING count(*) > 0""")
def sum_problems(spark, sf_dir):
    """FN-02, PR-07: sums with nan, infinity, words and overflow among their values are named."""
    kind = F.col("l_orderkey") % 5
    x = F.when(kind == 0, "nan").when(kind == 1, "-inf").when(kind == 2, "x").when(kind == 3, "1.7e308").otherwise("1")
    return sums.exact_sums(read(spark, sf_dir, "lineitem").select(kind.alias("kind"), x.alias("x")), "x", ["kind"])


# --- forests: perfect binary trees over customers, one per market segment -------------------------------------------

TIPS_SQL = """tips AS (SELECT c_mktsegment AS tree_id, c_custkey AS k, CAST(c_custkey AS VARCHAR) AS tip, c_nationkey AS species_id, CASE WHEN c_nationkey % 10 < 9 THEN CAST(c_nationkey % 3 // 2 AS VARCHAR) END AS trait FROM customer),
 lv AS (SELECT CAST(length(bin(max(c_custkey))) AS INTEGER) AS top FROM customer),
 clades AS (SELECT tree_id, (CAST(1 AS BIGINT) << (top - l)) - 1 + (k >> l) AS node_id, l, top, tip, k, species_id, trait FROM (SELECT *, unnest(range(top + 1)) AS l FROM tips, lv))"""


def tip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trait = F.when(F.col("c_nationkey") % 10 < 9, F.floor(F.col("c_nationkey") % 3 / 2).cast("int").cast("string"))
    # packed files are small beside their rows, so Spark would send them all through the driver (operators.store.stored)
    return read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("tree_id"), F.col("c_custkey").alias("k"), text("c_custkey").alias("tip"), F.col("c_nationkey").alias("species_id"), trait.alias("trait")).hint("merge")


def levels(spark: SparkSession, sf_dir: str) -> int:
    """Bits of the largest key."""
    return max(1, (read(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] or 0).bit_length())


def key_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored node tables: a tip is a key, its ancestors the key without its last bits; node ids count from the root, 0."""
    top = levels(spark, sf_dir)
    node_of = lambda level: F.lit((1 << (top - level)) - 1).cast("long") + F.shiftright(F.col("at"), level)
    own = tip_rows(spark, sf_dir).select("tree_id", F.col("k").alias("at"), "tip")
    own = prefix_sums(own, {"n": F.lit(1)}).select("tree_id", (F.col("n") - 1).alias("at"), "tip", F.posexplode(F.array(*[node_of(i) for i in range(top, -1, -1)])).alias("depth", "node_id"))
    each = own.groupBy("tree_id", "node_id", "depth").agg(F.min("at").alias("tin"), F.max("at").alias("tout"), F.max("tip").alias("t"))
    return stored(each.select(
        "tree_id", "node_id", F.when(F.col("depth") > 0, F.floor((F.col("node_id") - 1) / 2)).alias("parent_id"), F.when(F.col("depth") == top, F.col("t")).alias("name"), F.lit(1.0).alias("dist"),
        F.lit(None).cast("double").alias("support"), "depth", "tin", "tout", F.lit(None).cast("string").alias("problem"),
    ), "forest")


@query(f"WITH {TIPS_SQL} SELECT tree_id, node_id, count(*) AS samples, count(DISTINCT species_id) AS species, count(*) FILTER (WHERE trait = '0') AS zero, count(*) FILTER (WHERE trait = '1') AS one, count(*) FILTER (WHERE trait IS NULL) AS missing FROM clades GROUP BY ALL")
def clade_counts(spark, sf_dir):
    """TR-01, AG-20: tips, species and states below every node of every tree."""
    return forest.clade_counts(key_forest(spark, sf_dir), tip_rows(spark, sf_dir))


@query(f"""WITH {TIPS_SQL}, s AS (SELECT tree_id, node_id, l, min(trait) AS lo, max(trait) AS hi, count(*) AS n FROM clades WHERE trait IS NOT NULL GROUP BY ALL)
 SELECT s.tree_id, s.node_id, s.lo AS state, s.n FROM s LEFT JOIN s p ON p.tree_id = s.tree_id AND p.l = s.l + 1 AND p.node_id = (s.node_id - 1) // 2 WHERE s.lo = s.hi AND (p.lo <> p.hi OR s.node_id = 0)""")
def uniform_clades(spark, sf_dir):
    """TR-05: maximal clades with one observed state."""
    return forest.uniform_clades(key_forest(spark, sf_dir), tip_rows(spark, sf_dir)).select("tree_id", "node_id", "state", "n")


@query(f"""WITH {TIPS_SQL}, g AS (SELECT tree_id, species_id AS grp, tip FROM tips), c AS (SELECT tree_id, species_id AS grp, node_id, l, count(*) AS m FROM clades GROUP BY ALL), n AS (SELECT tree_id, species_id AS grp, count(*) AS n FROM tips GROUP BY ALL)
 SELECT tree_id, grp, arg_min(node_id, l) AS node_id FROM c JOIN n USING (tree_id, grp) WHERE m = n GROUP BY ALL""")
def clade_ancestors(spark, sf_dir):
    """TR-02: lowest common ancestor of each species' tips in each tree."""
    return forest.common_ancestors(key_forest(spark, sf_dir), tip_rows(spark, sf_dir).select(F.col("species_id").alias("grp"), "tip"))


@query(f"""WITH {TIPS_SQL}, n AS (SELECT tree_id, node_id, l, count(*) AS n, count(*) FILTER (WHERE k >> (top - 2) = 1) AS h FROM clades GROUP BY ALL), t AS (SELECT tree_id, n AS total, h AS k FROM n WHERE node_id = 0)
 SELECT tree_id, count(*) AS edges FROM n JOIN t USING (tree_id) WHERE node_id <> 0 AND k > 0 AND ((h = k AND n = k) OR (h = 0 AND n = total - k)) GROUP BY 1""")
def separating_edges(spark, sf_dir):
    """TR-03, TR-04: edges that part the second quarter of the keys from the rest."""
    group = tip_rows(spark, sf_dir).where(F.shiftright("k", levels(spark, sf_dir) - 2) == 1).select("tip")
    return forest.separating_edges(key_forest(spark, sf_dir), group).groupBy("tree_id").agg(F.count("*").alias("edges"))


@query(f"""WITH {TIPS_SQL}, q AS (SELECT tree_id, tip, k >> (top - 2) AS quarter, top FROM tips, lv), n AS (SELECT tree_id, count(*) FILTER (WHERE quarter = 1) AS hits FROM q GROUP BY 1)
 SELECT tree_id, tip, CASE quarter WHEN 1 THEN top - 2 + 0.5 WHEN 0 THEN top - 2 + 1.5 ELSE top + 1.5 END AS distance FROM q JOIN n USING (tree_id) WHERE hits > 0""")
def rerooted_trees(spark, sf_dir):
    """TR-04: trees turned so that their roots part the second quarter of the keys from the rest: lengths from the new root to every tip."""
    group = tip_rows(spark, sf_dir).where(F.shiftright("k", levels(spark, sf_dir) - 2) == 1).select("tip")
    return forest.root_distances(stored(forest.rerooted(key_forest(spark, sf_dir), group), "rerooted")).select("tree_id", "tip", "distance")


@query(f"""WITH {TIPS_SQL}, q AS (SELECT tree_id, k >> (top - 2) AS quarter, c_nationkey FROM (SELECT tips.*, top, species_id AS c_nationkey FROM tips, lv))
 SELECT DISTINCT tree_id, 'second_quarter' AS outgroup, true AS rooted, CAST(NULL AS VARCHAR) AS problem FROM q WHERE quarter = 1 UNION ALL SELECT tree_id, 'nation', NULL, 'not_monophyletic' FROM q WHERE c_nationkey = 3 GROUP BY tree_id
 UNION ALL SELECT DISTINCT tree_id, 'nobody', NULL, 'no_outgroup' FROM q UNION ALL SELECT DISTINCT tree_id, 'all', NULL, 'no_ingroup' FROM q""")
def outgroup_roots(spark, sf_dir):
    """TR-03, TR-04: whether trees can be rooted on four outgroups, and whether they are once they have been turned."""
    nodes, own = key_forest(spark, sf_dir), tip_rows(spark, sf_dir)
    quarter = own.where(F.shiftright("k", levels(spark, sf_dir) - 2) == 1).select("tip")
    turned = forest.root_check(stored(forest.rerooted(nodes, quarter), "rerooted"), quarter)
    out = turned.select("tree_id", F.lit("second_quarter").alias("outgroup"), "rooted", F.lit(None).cast("string").alias("problem"))
    for name, group in (("nation", own.where("species_id = 3")), ("nobody", own.where("false")), ("all", own)):
        edges = forest.outgroup_edges(nodes, group.select("tip")).where("problem is not null")
        out = out.unionByName(edges.select("tree_id", F.lit(name).alias("outgroup"), F.lit(None).cast("boolean").alias("rooted"), "problem"))
    return out


@query(f"""WITH {TIPS_SQL}, kept AS (SELECT * FROM clades WHERE k % 3 = 0), c AS (SELECT tree_id, node_id, l, top, count(*) AS n, min(k) AS a, max(k) AS b FROM kept GROUP BY ALL), r AS (SELECT tree_id, a, b, n, top, min(l) AS low, max(l) AS high FROM c GROUP BY ALL)
 SELECT tree_id, (CAST(1 AS BIGINT) << (top - low)) - 1 + (a >> low) AS node_id, CASE WHEN n = 1 THEN CAST(a AS VARCHAR) END AS name, CASE WHEN high < top THEN CAST(high - low + 1 AS DOUBLE) END AS dist, n AS tips FROM r""")
def pruned_trees(spark, sf_dir):
    """TR-10: trees cut to a keep list, lengths summed along contracted paths."""
    out = forest.pruned(key_forest(spark, sf_dir), tip_rows(spark, sf_dir).where("k % 3 = 0").select("tip"))
    return out.select("tree_id", "node_id", "name", "dist", (F.col("tout") - F.col("tin") + 1).cast("long").alias("tips"))


@query(f"""WITH {TIPS_SQL}, m AS (SELECT tree_id, node_id, l, max(species_id) AS below FROM clades GROUP BY ALL), b AS (SELECT tree_id, node_id, l, CAST(min(species_id) AS DOUBLE) AS minimum FROM clades WHERE l % 5 = 0 GROUP BY ALL),
 d AS (SELECT x.tree_id, x.node_id, max(y.minimum) AS below FROM b x JOIN b y ON x.tree_id = y.tree_id AND y.l < x.l AND ((y.node_id + 1) >> (x.l - y.l)) = x.node_id + 1 GROUP BY ALL)
 SELECT b.tree_id, b.node_id, minimum, below, coalesce(minimum + 3 < below, false) AS conflict, coalesce(minimum < below, false) AS redundant FROM b LEFT JOIN d USING (tree_id, node_id)""")
def age_conflicts(spark, sf_dir):
    """TR-11: bounds of ancestors against those of descendants."""
    nodes = key_forest(spark, sf_dir)
    low = forest.clade_tips(nodes).join(tip_rows(spark, sf_dir).select("tip", "species_id"), "tip").groupBy("tree_id", "node_id").agg(F.min("species_id").cast("double").alias("minimum"))
    bounds = low.join(nodes.where((F.lit(levels(spark, sf_dir)) - F.col("depth")) % 5 == 0).select("tree_id", "node_id"), ["tree_id", "node_id"]).withColumn("maximum", F.col("minimum") + 3)
    return forest.age_conflicts(nodes, bounds).select("tree_id", "node_id", "minimum", F.col("below"), "conflict", "redundant")


@query(f"WITH {TIPS_SQL} SELECT tree_id, tree_id <> 'BUILDING' OR count(*) < 4 AS same FROM tips GROUP BY 1")
def same_topology(spark, sf_dir):
    """TR-13: trees compared by their clades: some mirrored, with other lengths, and one whose tips all moved on by one."""
    nodes = key_forest(spark, sf_dir)
    own = forest.positions(nodes).select("tree_id", "at", F.col("tip").alias("name"))
    n = own.groupBy("tree_id").agg(F.count("*").alias("n"))
    shifted = own.join(n, "tree_id").select("tree_id", F.when(F.col("tree_id") == "BUILDING", (F.col("at") + 1) % F.col("n")).otherwise(F.col("at")).alias("at"), F.col("name").alias("moved"))
    tips = forest.tips(nodes).select("tree_id", "node_id", F.col("tin").alias("at")).join(shifted, ["tree_id", "at"]).select("tree_id", "node_id", "moved")
    other = nodes.join(tips, ["tree_id", "node_id"], "left").join(n, "tree_id").withColumn("name", F.col("moved"))
    mirror = F.col("tree_id") == "FURNITURE"
    other = other.withColumns({"tin": F.when(mirror, F.col("n") - 1 - F.col("tout")).otherwise(F.col("tin")), "tout": F.when(mirror, F.col("n") - 1 - F.col("tin")).otherwise(F.col("tout")), "dist": F.lit(2.0)})
    return forest.same_topology(nodes, other.drop("n", "moved"))


@query("SELECT c_nationkey AS clade, c_custkey AS name, c_acctbal AS score FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, md5('3/' || CAST(c_custkey AS VARCHAR)), c_custkey) = 1")
def clade_representatives(spark, sf_dir):
    """WN-09: the best-scored member of each clade, ties by a seeded hash."""
    own = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("clade"), F.col("c_custkey").alias("name"), F.col("c_acctbal").alias("score"))
    return forest.clade_representatives(own, "clade", "score", "name", seed=3).select("clade", "name", "score")


@query("WITH t AS (SELECT l_partkey AS node_id, l_suppkey AS f, l_quantity AS m, max(l_quantity) OVER (PARTITION BY l_partkey) AS top FROM lineitem) SELECT node_id, max(top) AS minimum, string_agg(DISTINCT CAST(f AS VARCHAR), ',' ORDER BY CAST(f AS VARCHAR)) FILTER (WHERE m = top) AS applied FROM t GROUP BY 1")
def node_minima(spark, sf_dir):
    """AG-19: largest minimum per node and which fossils give it."""
    own = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("node_id"), text("l_suppkey").alias("fossil"), F.col("l_quantity").alias("minimum"))
    return forest.node_minima(own).select("node_id", "minimum", "applied")


@query("""WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'delete' WHEN 2 THEN 'reverse' ELSE 'short' END AS kind, translate(md5(CAST(user_id AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS q, translate(md5(event_type || CAST(user_id AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS t, CAST(1 + user_id % 9 AS INTEGER) AS a FROM events)
 SELECT event_id, CASE kind WHEN 'insert' THEN q[a:a + 19] WHEN 'delete' THEN q[a:a + 4] || '---' || q[a + 5:a + 19] WHEN 'reverse' THEN reverse(translate(q[a:a + 19], 'ACGT', 'TGCA')) END AS query,
 CASE kind WHEN 'insert' THEN t[3:7] || '--' || t[8:20] WHEN 'delete' THEN t[3:25] WHEN 'reverse' THEN t[3:22] END AS target, CASE kind WHEN 'short' THEN 'coordinates' END AS problem FROM s""")
def gapped_alignments(spark, sf_dir):
    """FN-09: hits as pairs of gapped strings: insertions, deletions, reverse strands, and runs that don't end at the coordinates."""
    bases = lambda c: F.translate(F.md5(c), "0123456789abcdef", "ACGTACGTACGTACGT")
    kind, a = F.col("event_id") % 4, (F.col("user_id") % 9 + 1).cast("int")
    b = a + 19
    cigar = F.when(kind == 0, "5M2I13M").when(kind == 1, "5M3D15M").when(kind == 2, "0M20M").otherwise("19M")
    end = F.when(kind == 0, 20).when(kind == 1, 25).otherwise(22)
    own = read(spark, sf_dir, "events").select("event_id", bases(text("user_id")).alias("q"), bases(F.concat("event_type", text("user_id"))).alias("t"), F.when(kind == 2, b).otherwise(a).alias("a"), F.when(kind == 2, a).otherwise(b).alias("b"), end.alias("end"), cigar.alias("cigar"))
    return own.select("event_id", T.gapped(F.col("q"), F.col("t"), F.col("a"), F.col("b"), F.lit(3), F.col("end"), F.col("cigar")).alias("g")).select("event_id", "g.query", "g.target", "g.problem")


PAIRS_SQL_TAIL = """c AS (SELECT tree_id, node_id, l, any_value(top) AS top, count(*) AS n, min(k) AS a, max(k) AS b, min(trait) AS lo, max(trait) AS hi, min(tip) AS first FROM clades WHERE trait IS NOT NULL GROUP BY tree_id, node_id, l),
 r AS (SELECT tree_id, a, b, n, any_value(lo) AS lo, any_value(hi) AS hi, any_value(top) AS top, min(l) AS low, max(l) AS high, arg_min(node_id, l) AS node_id, any_value(first) AS first FROM c GROUP BY tree_id, a, b, n),
 up AS (SELECT r.*, c.a AS pa, c.b AS pb, c.n AS pn FROM r JOIN c ON c.tree_id = r.tree_id AND c.l = r.high + 1 AND c.node_id = (CAST(1 AS BIGINT) << greatest(r.top - r.high - 1, 0)) - 1 + (r.a >> (r.high + 1))),
 met AS (SELECT tree_id, pa, pb, pn, count(*) FILTER (WHERE lo = hi AND lo = '0') AS z, count(*) FILTER (WHERE lo = hi AND lo = '1') AS o, count(*) AS children, CAST(sum(n) FILTER (WHERE lo = hi AND lo = '0') AS BIGINT) AS zero, CAST(sum(n) FILTER (WHERE lo = hi AND lo = '1') AS BIGINT) AS one FROM up GROUP BY tree_id, pa, pb, pn),
 pairs AS (SELECT met.tree_id, r.node_id, CAST(row_number() OVER (PARTITION BY met.tree_id ORDER BY r.first) AS INTEGER) AS pair_id, true AS resolved, zero, one FROM met JOIN r ON r.tree_id = met.tree_id AND r.a = pa AND r.b = pb AND r.n = pn WHERE z = 1 AND o = 1 AND children = 2)"""
PAIRS_SQL = f"{TIPS_SQL}, {PAIRS_SQL_TAIL}"


# --- subsets of a whole result set -----------------------------------------------------------------------------------

@query("""WITH k AS (SELECT c_custkey FROM customer WHERE c_nationkey % 3 = 0), o AS (SELECT o_orderkey, o_custkey FROM orders)
 SELECT 'customer' AS "table", (SELECT count(*) FROM customer) AS rows_before, (SELECT count(*) FROM k) AS rows_after UNION ALL SELECT 'orders', (SELECT count(*) FROM o), (SELECT count(*) FROM o WHERE o_custkey IN (SELECT c_custkey FROM k)) UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part)""")
def subset_counts(spark, sf_dir):
    """SO-05, SO-07, AG-23: every table cut to a keep list, rows before and after."""
    customer = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "sample")
    tables = {"customer": subset.Table(customer), "orders": subset.Table(read(spark, sf_dir, "orders"), sample="o_custkey"), "part": subset.Table(read(spark, sf_dir, "part"), "whole")}
    return subset.subset_counts(tables, subset.subset(tables, customer.where("c_nationkey % 3 = 0")))


#: Samples are customers, runs their orders, expression the lines of orders, long, wide and as counts; alignments are events, by type.
KEPT_SQL = """WITH samples AS (SELECT * FROM customer WHERE c_nationkey % 5 < 3), runs AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM samples)), expr AS (SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM runs))"""
KEPT_TIPS_SQL = TIPS_SQL.replace("c_nationkey % 10 < 9", "c_nationkey % 5 < 3 AND c_nationkey % 10 < 9")


def result_set(spark: SparkSession, sf_dir: str) -> dict[str, subset.Node]:
    line = read(spark, sf_dir, "lineitem")
    flags = [F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity").cast("decimal(18,2)"))).alias(f) for f in "ANR"]
    old_pairs = tip_rows(spark, sf_dir).select("tree_id", F.lit("stale").alias("pair_id"))
    return {
        "pairs": subset.Node(old_pairs, "pairs", parent="forest", traits="traits"),
        "forest": subset.Node(key_forest(spark, sf_dir), "forest", parent="samples", parent_key="tip", group="tree_id"),
        "samples": subset.Node(read(spark, sf_dir, "customer").withColumn("tip", text("c_custkey")), "keep", "c_custkey"),
        "traits": subset.Node(tip_rows(spark, sf_dir).select("tip", "trait"), "rows", "tip", "samples", "tip", unique=True, complete=True),
        "runs": subset.Node(read(spark, sf_dir, "orders"), "rows", "o_custkey", "samples", "c_custkey"),
        "expression": subset.Node(line, "rows", "l_orderkey", "runs", "o_orderkey"),
        "expression_wide": subset.Node(line.groupBy("l_orderkey").agg(*flags), "rows", "l_orderkey", "runs", "o_orderkey", unique=True),
        "quality": subset.Node(line.groupBy("l_orderkey").agg(F.count("*").alias("genes")), "rows", "l_orderkey", "runs", "o_orderkey", unique=True),
        "alignments": subset.Node(read(spark, sf_dir, "events").where("user_id > 0"), "groups", "user_id", "samples", "c_custkey", group="event_type"),
        "labels": subset.Node(read(spark, sf_dir, "part"), "whole"),
    }


@query(f"""{KEPT_SQL}, {KEPT_TIPS_SQL.replace("tips AS (", "all_tips AS (", 1).replace("FROM tips, lv", "FROM all_tips, lv")}, cut AS (SELECT * FROM clades WHERE species_id % 5 < 3), big AS (SELECT tree_id FROM cut WHERE l = 0 GROUP BY 1 HAVING count(*) > 1), spans AS (SELECT DISTINCT tree_id, n, a, b FROM (SELECT tree_id, node_id, count(*) AS n, min(k) AS a, max(k) AS b FROM cut GROUP BY ALL) JOIN big USING (tree_id)),
 {PAIRS_SQL_TAIL}
 SELECT 'samples' AS "table", 'keep' AS rule, (SELECT count(*) FROM customer) AS rows_before, (SELECT count(*) FROM samples) AS rows_after, 0 AS orphans
 UNION ALL SELECT 'runs', 'rows', (SELECT count(*) FROM orders), (SELECT count(*) FROM runs), 0 UNION ALL SELECT 'expression', 'rows', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM expr), 0
 UNION ALL SELECT 'expression_wide', 'rows', (SELECT count(DISTINCT l_orderkey) FROM lineitem), (SELECT count(DISTINCT l_orderkey) FROM expr), 0 UNION ALL SELECT 'quality', 'rows', (SELECT count(DISTINCT l_orderkey) FROM lineitem), (SELECT count(DISTINCT l_orderkey) FROM expr), 0
 UNION ALL SELECT 'traits', 'rows', (SELECT count(*) FROM customer), (SELECT count(*) FROM samples), 0 UNION ALL SELECT 'alignments', 'groups', (SELECT count(*) FROM events WHERE user_id > 0), (SELECT count(*) FROM events WHERE user_id > 0 AND user_id IN (SELECT c_custkey FROM samples)), 0
 UNION ALL SELECT 'labels', 'whole', (SELECT count(*) FROM part), (SELECT count(*) FROM part), 0
 UNION ALL SELECT 'forest', 'forest', (SELECT count(*) FROM (SELECT DISTINCT tree_id, node_id FROM clades)), (SELECT count(*) FROM spans), 0
 UNION ALL SELECT 'pairs', 'pairs', (SELECT count(*) FROM customer), (SELECT count(*) FROM met WHERE z > 0 AND o > 0 AND z + o = children), 0""")
def subset_graph(spark, sf_dir):
    """SO-05, AG-23: ten linked tables cut by one keep list: samples, runs, expression long, wide and quality, traits, alignments, pruned
    trees, pairs found again on them, labels; rows before and after, and keys without a parent."""
    keep = read(spark, sf_dir, "customer").where("c_nationkey % 5 < 3").select(F.col("c_custkey").alias("sample"))
    return subset.write_graph(result_set(spark, sf_dir), keep)[1]


@query("""WITH s AS (SELECT c_custkey FROM customer WHERE c_nationkey % 5 < 3), k AS (SELECT c_custkey FROM customer)
 SELECT 'runs' AS "table", 'orphan' AS problem, CAST(o_custkey AS VARCHAR) AS "key" FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM s) GROUP BY ALL
 UNION ALL SELECT 'quality', 'missing', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL
 UNION ALL SELECT 'expression', 'repeated', CAST(l_orderkey AS VARCHAR) FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
 UNION ALL SELECT 'samples', 'unknown', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey % 5 = 4""")
def subset_problems(spark, sf_dir):
    """SO-05, PR-18: sources that don't fit together, named before a subset: unknown keys to keep, orphans, repeated and missing keys."""
    graph = {
        "samples": subset.Node(read(spark, sf_dir, "customer").where("c_nationkey % 5 < 3"), "keep", "c_custkey"),
        "runs": subset.Node(read(spark, sf_dir, "orders"), "rows", "o_custkey", "samples", "c_custkey"),
        "expression": subset.Node(read(spark, sf_dir, "lineitem"), "rows", "l_orderkey", "runs", "o_orderkey", unique=True),
        "quality": subset.Node(read(spark, sf_dir, "lineitem"), "rows", "l_orderkey", "runs", "o_orderkey", complete=True),
    }
    keep = read(spark, sf_dir, "customer").where("c_nationkey % 5 < 3 or c_nationkey % 5 = 4").select(F.col("c_custkey").alias("sample"))
    return subset.graph_problems(graph, keep)


@query("""WITH s AS (SELECT c_custkey FROM customer WHERE c_custkey % 97 = 5), g AS (SELECT user_id // 10 AS og, user_id FROM events)
 SELECT 'alignments' AS "table", CAST(og AS VARCHAR) AS "group" FROM g GROUP BY og HAVING count(*) FILTER (WHERE user_id IN (SELECT c_custkey FROM s)) = 0
 UNION ALL SELECT 'forest', c_mktsegment FROM customer GROUP BY c_mktsegment HAVING count(*) FILTER (WHERE c_custkey % 97 = 5) < 2""")
def subset_dropped(spark, sf_dir):
    """SO-05: alignments left empty and trees left with fewer than two tips by a short keep list."""
    graph = {
        "samples": subset.Node(read(spark, sf_dir, "customer").withColumn("tip", text("c_custkey")), "keep", "c_custkey"),
        "alignments": subset.Node(read(spark, sf_dir, "events").select("user_id", F.floor(F.col("user_id") / 10).alias("og")), "groups", "user_id", "samples", "c_custkey", group="og"),
        "forest": subset.Node(key_forest(spark, sf_dir), "forest", parent="samples", parent_key="tip"),
    }
    keep = read(spark, sf_dir, "customer").where("c_custkey % 97 = 5").select(F.col("c_custkey").alias("sample"))
    return subset.dropped_in_graph(graph, subset.cut_graph(graph, keep))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def without_flagged(spark, sf_dir):
    """SO-06: flagged samples removed."""
    flagged = read(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return subset.without_flagged({"orders": read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")}, flagged, "o_custkey")["orders"]


@query("""SELECT c_custkey AS species, CAST(c_nationkey % 2 AS VARCHAR) AS trait, CASE WHEN c_custkey % 4 < 3 THEN CAST(c_custkey // 8 AS VARCHAR) END AS contrast_pair_id, c_custkey % 12 = 0 AS conflict FROM customer""")
def contrast_metadata(spark, sf_dir):
    """JN-10, JN-11: pair ids attached, earlier ones wiped, traits compared."""
    k = F.col("c_custkey")
    base = read(spark, sf_dir, "customer").select(k.alias("species"), (F.col("c_nationkey") % 2).cast("string").alias("trait"), F.lit("stale").alias("contrast_pair_id"))
    branch = base.where("species % 4 < 3").select("species", F.when(F.col("species") % 12 == 0, F.lit("9")).otherwise(F.col("trait")).alias("trait"), F.floor(F.col("species") / 8).cast("string").alias("contrast_pair_id"))
    return subset.attach_pairs(base, branch)


@query(f"""WITH {NODES_SQL}, c AS (SELECT anc, count(DISTINCT taxid) AS n FROM up GROUP BY 1), x AS (SELECT u.taxid, u.depth, u.anc, c.n FROM up u JOIN c USING (anc)), y AS (SELECT taxid, n, min(depth) AS depth, arg_min(anc, depth) AS node FROM x WHERE n > 1 GROUP BY taxid, n),
 z AS (SELECT taxid, depth, node FROM y UNION ALL SELECT DISTINCT taxid, -1, taxid FROM up), w AS (SELECT node AS child, lead(node) OVER (PARTITION BY taxid ORDER BY depth) AS parent FROM z) SELECT DISTINCT child, parent FROM w WHERE parent IS NOT NULL AND parent <> child""")
def guide_tree(spark, sf_dir):
    """TR-12: edges of the taxonomy over the taxa, without nodes of one child."""
    return taxonomy.guide_edges(tax_lineage(spark, sf_dir))


@query(f"""WITH {NODES_SQL}, a AS (SELECT c_custkey AS query, CASE WHEN c_custkey % 2 = 0 THEN 1000 + c_custkey WHEN c_custkey % 3 = 0 THEN 100 + c_nationkey END AS taxid, CASE WHEN c_custkey % 2 = 0 THEN 'species' ELSE 'family' END AS by FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1 OR c_custkey % 2 = 0 AND n_regionkey = 1)
 SELECT * FROM a WHERE taxid IS NOT NULL""")
def resolved_names(spark, sf_dir):
    """JN-14: names by rank priority, without regard to case, below one clade."""
    own = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    asked = own.select(k.alias("query"), F.when(k % 2 == 0, F.upper("c_name")).alias("species"), F.lit("none").alias("genus"), F.when(k % 3 == 0, F.lower("n_name")).alias("family"))
    nodes = tax_nodes(spark, sf_dir)
    return taxonomy.resolve_names(asked, nodes.select("taxid", "name", "rank"), taxonomy.lineages(nodes, nodes.select("taxid")), 11)


@query("""WITH h AS (SELECT l_suppkey AS sample, l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN '-' ELSE '' END || CAST(l_partkey AS VARCHAR) AS p FROM lineitem), s AS (SELECT CAST(p_partkey AS VARCHAR) AS p, CASE WHEN p_size = 1 THEN 2 ELSE 1 END AS n FROM part)
 SELECT CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'doubly_matched' END AS problem, CAST(sum(coalesce(n, 1)) AS BIGINT) AS n FROM h LEFT JOIN s USING (p) GROUP BY 1""")
def hit_sequences(spark, sf_dir):
    """JN-17: hits joined to sequences, coordinates and strand stripped; missing and double ones named."""
    line = read(spark, sf_dir, "lineitem")
    hit = F.concat(F.when(F.col("l_linenumber") == 7, F.lit("-")).otherwise(F.lit("")), text("l_partkey"), F.lit(":1-"), text("l_linenumber"), F.lit("|+"))
    hits = line.select(F.lit("s").alias("sample"), hit.alias("hit"))
    part = read(spark, sf_dir, "part").select(F.lit("s").alias("sample"), text("p_partkey").alias("gene_id"), "p_size")
    return selection.count_by(mapping.hits_with_sequences(hits, part.union(part.where("p_size = 1"))), "problem")


@query(r"""SELECT doc_id, CASE WHEN p = '' THEN NULL ELSE p END AS protein, CASE WHEN known < 200 THEN 'short_protein' WHEN 1 - known / n > 0.13 THEN 'ambiguous_protein' END AS problem FROM (SELECT doc_id, p, length(p) AS n, length(p) - length(regexp_replace(p, '[ACDEFGHIKLMNPQRSTVWY]', '', 'g')) AS known FROM (SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS p FROM documents))""")
def protein_filters(spark, sf_dir):
    """PR-15, PR-16: protein normalisation and residue filters."""
    p = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    own = read(spark, sf_dir, "documents").select("doc_id", F.concat(p, F.lit("*")).alias("raw"), p.alias("p"))
    return own.select("doc_id", T.normalized_protein(F.col("raw")).alias("protein"), T.sequence_problem(F.col("p"), 200, 0.13).alias("problem"))


@query("SELECT label, split_part(label, '_', 1) AS order_name, split_part(label, '_', 2) AS family, split_part(label, '_', 3) AS genus, array_to_string(string_split(label, '_')[4:], '_') AS rest FROM (SELECT p_type || '_' || p_brand || '_' || replace(p_name, ' ', '_') || '_x_y' AS label FROM part)")
def tree_labels(spark, sf_dir):
    """FN-13: labels of four parts."""
    label = F.concat_ws("_", "p_type", "p_brand", F.translate("p_name", " ", "_"), F.lit("x_y"))
    return read(spark, sf_dir, "part").select(label.alias("label")).select("label", T.label_parts(F.col("label")).alias("p")).select("label", "p.*")


@query("SELECT event_id, n AS aligned, 10 + n + CASE WHEN event_id % 2 = 0 THEN 3 ELSE 0 END AS last_query, 5 + n - 1 + CASE WHEN event_id % 2 = 1 THEN 2 ELSE 0 END + 1 AS last_target FROM (SELECT event_id, 2 + user_id % 50 + 4 AS n FROM events)")
def cigar_positions(spark, sf_dir):
    """FN-09: positions that CIGAR texts align."""
    n = F.col("user_id") % 50 + 2
    cigar = F.concat(n.cast("string"), F.when(F.col("event_id") % 2 == 0, F.lit("M3I4M")).otherwise(F.lit("M2D4M")))
    own = read(spark, sf_dir, "events").select("event_id", T.aligned_positions(cigar, F.lit(11), F.lit(6)).alias("a"))
    end = F.element_at("a", -1)
    return own.select("event_id", F.size("a").cast("long").alias("aligned"), end["q"].cast("long").alias("last_query"), end["t"].cast("long").alias("last_target"))


@query(f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def trait_pairs(spark, sf_dir):
    """TR-06: contrast pairs of every tree, with their tips in each state."""
    return forest.contrast_pairs(key_forest(spark, sf_dir), tip_rows(spark, sf_dir))


@query(f"""WITH {PAIRS_SQL}, x AS (SELECT c.tree_id, c.tip, c.trait, p.node_id, max(c.k * 7 % 1009) OVER (PARTITION BY c.tree_id, p.node_id, c.trait) AS best FROM clades c JOIN pairs p ON p.tree_id = c.tree_id AND p.node_id = c.node_id WHERE c.trait IS NOT NULL)
 SELECT t.tree_id, t.tip, x.node_id AS pair_node, x.best, CASE WHEN t.trait IS NULL THEN 'no_trait' WHEN x.node_id IS NULL THEN 'unpaired' END AS reason FROM tips t LEFT JOIN x USING (tree_id, tip)""")
def representative_pairs(spark, sf_dir):
    """TR-08, WN-09: pairs found on trees of one tip for each uniform clade, and all tips behind them; ties of scores by a seeded hash."""
    own = tip_rows(spark, sf_dir).withColumn("score", F.col("k") * 7 % 1009)
    out = forest.representative_pairs(key_forest(spark, sf_dir), own, own)
    scores = own.select(F.col("tip").alias("representative"), F.col("score").alias("best"))
    out = out.withColumn("representative", F.when(F.col("reason").isNull(), F.col("representative"))).join(scores, "representative", "left")
    return out.select("tree_id", "tip", "pair_node", "best", "reason")


@query(f"""WITH {PAIRS_SQL}, pt AS (SELECT clades.tree_id, pair_id, tip FROM clades JOIN pairs USING (tree_id, node_id) WHERE trait IS NOT NULL), size AS (SELECT tree_id, pair_id, count(*) AS size FROM pt GROUP BY ALL),
 s AS (SELECT clades.tree_id, node_id, l, count(DISTINCT pair_id) AS p, min(pair_id) AS pair_id, count(DISTINCT tip) AS n FROM clades JOIN pt USING (tree_id, tip) GROUP BY clades.tree_id, node_id, l),
 top AS (SELECT tree_id, pair_id AS block_id, arg_max(node_id, l) AS node_id FROM s JOIN size USING (tree_id, pair_id) WHERE p = 1 AND n = size GROUP BY ALL)
 SELECT tree_id, block_id, tip FROM clades JOIN top USING (tree_id, node_id) WHERE trait IS NOT NULL""")
def phylogenetic_blocks(spark, sf_dir):
    """TR-07, TR-08: blocks around the pairs of every tree; tips join by their state."""
    nodes, own = key_forest(spark, sf_dir), tip_rows(spark, sf_dir)
    members = stored(forest.pair_tips(nodes, stored(forest.contrast_pairs(nodes, own), "pairs"), own), "pair-tips")
    return forest.blocks(nodes, members, own.where("trait is not null").select("tip"))


@query(f"""WITH {TIPS_SQL}, a AS (SELECT tree_id, node_id, any_value(top - l) AS depth, count(*) AS n FROM clades GROUP BY tree_id, node_id), f AS (SELECT tree_id, CAST(species_id AS VARCHAR) AS taxon, node_id, count(*) AS m FROM clades GROUP BY ALL), z AS (SELECT tree_id, CAST(species_id AS VARCHAR) AS taxon, count(*) AS size FROM tips GROUP BY ALL),
 p AS (SELECT * FROM f JOIN a USING (tree_id, node_id) JOIN z USING (tree_id, taxon)), c AS (SELECT tree_id, taxon, size, min(n) AS clade_size FROM p WHERE m = size GROUP BY ALL), h AS (SELECT tree_id, taxon, m, n, node_id FROM p WHERE m >= 0.5 * n QUALIFY row_number() OVER (PARTITION BY tree_id, taxon ORDER BY m DESC, n, depth, node_id) = 1)
 SELECT tree_id, 'family' AS rank, taxon, CASE WHEN size = 1 THEN 'monotypic' WHEN size = clade_size THEN 'monophyletic' ELSE 'non_monophyletic' END AS status, size, clade_size, CASE WHEN size <> clade_size THEN h.n - h.m ELSE 0 END AS intruders, CASE WHEN size <> clade_size THEN size - h.m ELSE 0 END AS outliers, h.node_id AS core_node FROM c LEFT JOIN h USING (tree_id, taxon)""")
def monophyly(spark, sf_dir):
    """TR-09: status, intruders and outliers of every species in every tree."""
    taxa = tip_rows(spark, sf_dir).select("tip", F.lit("family").alias("rank"), text("species_id").alias("taxon"))
    return forest.monophyly(key_forest(spark, sf_dir), taxa)


@query(f"WITH {TIPS_SQL}, k AS (SELECT tree_id, (node_id - 1) // 2 AS up, count(DISTINCT node_id) AS n FROM clades WHERE node_id > 0 GROUP BY ALL), w AS (SELECT count(*) AS n FROM tips WHERE k % 2 = 0), t AS (SELECT tree_id, count(*) FILTER (WHERE k % 2 = 0) AS known, count(*) FILTER (WHERE k % 2 = 1) AS more FROM tips GROUP BY 1) SELECT DISTINCT tree_id, 'not_binary' AS problem FROM k WHERE n <> 2 UNION ALL SELECT tree_id, 'missing_tip' FROM t, w WHERE known < n UNION ALL SELECT tree_id, 'unexpected_tip' FROM t WHERE more > 0")
def tree_problems(spark, sf_dir):
    """TR-03: nodes with other than two children, tips missing or unexpected."""
    return forest.tree_problems(key_forest(spark, sf_dir), tip_rows(spark, sf_dir).where("k % 2 = 0").select("tip"))


@query(f"""WITH {TIPS_SQL}, a AS (SELECT tree_id, node_id, any_value(top - l) AS depth, count(*) AS n FROM clades GROUP BY tree_id, node_id), f AS (SELECT tree_id, species_id, node_id, count(*) AS m FROM clades GROUP BY ALL), z AS (SELECT tree_id, species_id, count(*) AS size FROM tips GROUP BY ALL),
 p AS (SELECT * FROM f JOIN a USING (tree_id, node_id) JOIN z USING (tree_id, species_id)), c AS (SELECT tree_id, species_id, size, min(n) AS clade_size FROM p WHERE m = size GROUP BY ALL), h AS (SELECT tree_id, species_id, node_id FROM p WHERE m >= 0.5 * n QUALIFY row_number() OVER (PARTITION BY tree_id, species_id ORDER BY m DESC, n, depth, node_id) = 1),
 g AS (SELECT tree_id, species_id, node_id FROM c JOIN h USING (tree_id, species_id) WHERE size > 1 AND size <> clade_size), w AS (SELECT g.tree_id, g.species_id, clades.tip, clades.species_id AS own FROM g JOIN clades ON clades.tree_id = g.tree_id AND clades.node_id = g.node_id)
 SELECT tree_id, CAST(species_id AS VARCHAR) AS taxon, tip, 'intruder' AS role FROM w WHERE own <> species_id
 UNION ALL SELECT g.tree_id, CAST(g.species_id AS VARCHAR), tips.tip, 'outlier' FROM g JOIN tips USING (tree_id, species_id) WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.tree_id = g.tree_id AND w.species_id = g.species_id AND w.tip = tips.tip)""")
def monophyly_roles(spark, sf_dir):
    """TR-09: which samples keep each species from being one clade: intruders in its core and outliers."""
    nodes = key_forest(spark, sf_dir)
    taxa = tip_rows(spark, sf_dir).select("tip", F.lit("family").alias("rank"), text("species_id").alias("taxon"))
    groups = stored(forest.monophyly(nodes, taxa), "monophyly")
    return forest.monophyly_roles(nodes, taxa, groups).select("tree_id", "taxon", "tip", "role")


@query(f"""WITH {TIPS_SQL}, x AS (SELECT tree_id, node_id, count(DISTINCT species_id) AS species, max(k * 7 % 1009) AS best, arg_min(tip, struct_pack(a := -(k * 7 % 1009), b := tip)) AS anchor FROM clades WHERE l = top - 1 GROUP BY tree_id, node_id)
 SELECT tree_id, node_id, species, anchor FROM x QUALIFY row_number() OVER (PARTITION BY tree_id ORDER BY species, best DESC, anchor) = 1""")
def basal_clade(spark, sf_dir):
    """WN-11: of the root's children the one with the fewest species, then the best tip."""
    return forest.basal_clade(key_forest(spark, sf_dir), tip_rows(spark, sf_dir).withColumn("score", F.col("k") * 7 % 1009))


@query(f"WITH {TIPS_SQL} SELECT tree_id, tip, species_id, 's' || tip AS sample, n_name AS family, n_regionkey AS taxid, CAST(species_id % 2 AS VARCHAR) AS trait FROM tips JOIN nation ON n_nationkey = species_id")
def tip_annotations(spark, sf_dir):
    """JN-23: tips with sample, ranks and trait."""
    own = tip_rows(spark, sf_dir).join(read(spark, sf_dir, "nation"), F.col("species_id") == F.col("n_nationkey")).select("tip", F.concat(F.lit("s"), "tip").alias("sample"), "species_id", F.col("n_nationkey").alias("taxid"))
    ranks = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("taxid"), F.col("n_name").alias("family"), F.col("n_regionkey").alias("order"))
    traits = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("species_id"), (F.col("n_nationkey") % 2).cast("string").alias("trait"))
    out = forest.tip_annotations(key_forest(spark, sf_dir), own, ranks, traits, "trait")
    return out.select("tree_id", "tip", "species_id", "sample", "family", F.col("order").alias("taxid"), "trait")
