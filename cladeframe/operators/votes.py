"""Votes of loci on the registered taxon, with exact shares."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_BASES, MIN_RESIDUES = 150, 50
WHOLE = "decimal(38,0)"


def least_common_multiple(sizes: Column) -> Column:
    """Of an array of positive integers, as decimal; more than 38 digits are an error."""
    one = F.lit(1).cast(WHOLE)

    def divisor(a: Column, b: Column) -> Column:
        # after the first step both are below b, which an int's Fibonacci numbers bound to 46 steps
        steps = F.sequence(F.lit(1), F.lit(48))
        start = F.struct(a.cast(WHOLE).alias("a"), b.cast(WHOLE).alias("b"))
        return F.aggregate(steps, start, lambda s, _: F.struct(F.when(s["b"] == 0, s["a"]).otherwise(s["b"]).alias("a"), F.when(s["b"] == 0, s["b"]).otherwise(s["a"] % F.greatest(s["b"], one)).cast(WHOLE).alias("b")), lambda s: s["a"])

    return F.aggregate(sizes, one, lambda m, n: (m * (n.cast(WHOLE) / divisor(m, n)).cast(WHOLE)).cast(WHOLE))


def best_hits(hits: DataFrame, taxa: DataFrame, query: str = "query", target: str = "target", score: str = "raw") -> DataFrame:
    """Best hit per (query, rank, taxon), with taxa(target, rank, taxon): highest score, then smallest target."""
    ranked = hits.join(taxa, target)
    best = ranked.groupBy(query, "rank", "taxon").agg(F.min_by(F.struct(*hits.columns), F.struct(-F.col(score), F.col(target))).alias("h"))
    return best.select("rank", "taxon", "h.*")


def locus_votes(hits: DataFrame, protein: bool = False) -> DataFrame:
    """(run, rank, locus, vote, winners, shared, registered_matches, alternative_matches) from hits(run, rank, locus,
    length, registered, taxon, score, matched): one best hit per taxon, matched being array<struct<pos, ok>> over the
    locus' positions.

    The registered taxon meets the alternatives with the highest score, on the positions that all of them share; these
    must be max(least, ceil(0.7 * length)).
    """
    least = MIN_RESIDUES if protein else MIN_BASES
    key = ["run", "rank", "locus"]
    # two arrays of numbers take a fifth of what an array of structs does where rows are shuffled
    every, right = F.transform("matched", lambda x: x["pos"]), F.transform(F.filter("matched", lambda x: x["ok"]), lambda x: x["pos"])
    hits = hits.withColumn("matched", F.struct(every.alias("pos"), right.alias("good")))
    own = hits.groupBy(*key).agg(
        F.max("length").alias("length"), F.max(F.when(F.col("taxon") == F.col("registered"), F.struct("matched"))).alias("mine"),
        F.max(F.when(F.col("taxon") != F.col("registered"), F.col("score"))).alias("top"),
    )
    rivals = hits.where(F.col("taxon") != F.col("registered")).join(own.select(*key, "top"), key).where(F.col("score") == F.col("top"))
    rivals = rivals.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("taxon", "matched"))).alias("rivals"))  # one per taxon
    out = own.join(rivals, key, "left")
    positions = lambda m: m["pos"]
    good = lambda m: m["good"]
    mine = F.col("mine.matched")
    shared = F.aggregate("rivals", positions(mine), lambda acc, r: F.array_intersect(acc, positions(r["matched"])))
    out = out.withColumn("shared", F.when(F.col("mine").isNotNull() & F.col("rivals").isNotNull(), shared))
    score = F.transform("rivals", lambda r: F.struct(r["taxon"].alias("taxon"), F.size(F.array_intersect(good(r["matched"]), F.col("shared"))).alias("n")))
    out = out.withColumn("old", F.size(F.array_intersect(good(mine), F.col("shared")))).withColumn("scores", score)
    out = out.withColumn("new", F.array_max(F.transform("scores", lambda s: s["n"])))
    out = out.withColumn("best", F.transform(F.filter("scores", lambda s: s["n"] == F.col("new")), lambda s: s["taxon"]))
    enough = F.size("shared") >= F.greatest(F.lit(least), F.floor((7 * F.col("length") + 9) / 10))
    tie = F.lit("uninformative_tie" if protein else "tie")
    vote = (
        F.when(F.col("mine").isNull(), "no_registered_hit").when(F.col("rivals").isNull(), "no_alternative_hit").when(~enough, "insufficient_overlap")
        .when(F.col("old") > F.col("new"), "registered").when(F.lit(protein) & (F.size("best") > 1), "uninformative_tie").when(F.col("old") < F.col("new"), "alternative").otherwise(tie)
    )
    counted = vote.isin("registered", "alternative", "tie", "uninformative_tie")
    return out.select(
        *key, vote.alias("vote"), F.when(vote.isin("alternative", "tie", "uninformative_tie"), F.col("best")).alias("winners"),
        F.when(counted, F.size("shared")).alias("shared"), F.when(counted, F.col("old")).alias("registered_matches"), F.when(counted, F.col("new")).alias("alternative_matches"),
    )


def vote_summary(votes: DataFrame, least: int, cutoff: str, by: tuple[str, ...] = ("run", "rank")) -> DataFrame:
    """Per run and rank: comparable loci, registered votes, leading alternative and its votes, supports, tied loci and
    status. A locus won by n shares its vote, a tie also with the registered taxon; the cut is strict and exact."""
    keys = list(by)
    whole = lambda c: c.cast(WHOLE)
    n = F.when(F.col("vote").isin("alternative", "tie"), F.size("winners") + (F.col("vote") == "tie").cast("int"))
    own = votes.withColumn("n", n).withColumn("voted", F.col("vote").isin("registered", "alternative", "tie"))
    # shares of a run and rank have one denominator, the least that all of its ties divide
    common = own.groupBy(*keys).agg(F.collect_set("n").alias("sizes")).select(*keys, least_common_multiple(F.array_sort("sizes")).alias("den"))
    own = own.join(common, keys).withColumn("share", whole(F.col("den") / F.col("n")))
    mine = F.when(F.col("vote") == "registered", F.col("den")).when(F.col("vote") == "tie", F.col("share"))
    totals = own.groupBy(*keys).agg(
        F.count_if("voted").alias("comparable_loci"), F.max("den").alias("den"), F.coalesce(F.sum(mine), F.lit(0).cast(WHOLE)).alias("mine"),
        F.count_if(F.col("vote").isin("tie", "uninformative_tie")).alias("tied_loci"), F.count_if(F.col("vote").isin("alternative", "tie")).alias("alternative_loci"),
    )
    rivals = own.where(F.col("share").isNotNull()).select(*keys, F.explode("winners").alias("alternative"), "share", "den").groupBy(*keys, "alternative").agg(F.sum("share").alias("votes"), F.max("den").alias("den"))
    lead = rivals.groupBy(*keys).agg(F.min_by(F.struct("alternative", "votes"), F.struct(-F.col("votes"), F.col("alternative"))).alias("x"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("alternative", (F.col("votes").cast("double") / F.col("den").cast("double")).alias("n"))))).alias("alternative_counts"))
    out = totals.join(lead, keys, "left")
    loci, cut = F.col("comparable_loci"), Fraction(cutoff)
    status = F.when(loci < least, "insufficient_comparison").when(whole(F.col("mine") * cut.denominator) < whole(loci * F.col("den") * cut.numerator), "discordant").otherwise("no_discordance")
    over = lambda c: (c.cast("double") / F.col("den").cast("double"))
    per = lambda c: F.when(loci > 0, over(c) / loci)
    return out.select(
        *keys, status.alias("status"), loci, over(F.col("mine")).alias("registered_votes"), "tied_loci", "alternative_loci", F.col("x.alternative").alias("alternative"),
        F.coalesce(over(F.col("x.votes")), F.lit(0.0)).alias("alternative_votes"), per(F.col("mine")).alias("registered_support"), per(F.col("x.votes")).alias("support"), "alternative_counts",
    )


def redecide(votes: DataFrame, least: int, cutoff: str) -> DataFrame:
    """Saved votes under a new cutoff."""
    return vote_summary(votes, least, cutoff)


def deciding_rank(summary: DataFrame, samples: DataFrame, order: list[str], least: int) -> DataFrame:
    """One row per run: the first rank with enough comparable loci, else the last one that was assessed; no_reference
    where no rank was."""
    place = F.coalesce(*[F.when(F.col("rank") == r, F.lit(i)) for i, r in enumerate(order)])
    own = summary.withColumn("__p", place).where("__p is not null")
    enough = F.col("comparable_loci") >= least
    chosen = own.groupBy("run").agg(F.min(F.when(enough, F.col("__p"))).alias("first"), F.max("__p").alias("last"))
    best = own.join(chosen.select("run", F.coalesce("first", "last").alias("__p")), ["run", "__p"]).drop("__p")
    out = samples.select("run").distinct().join(best, "run", "left")
    return out.withColumn("status", F.coalesce("status", F.lit("no_reference")))


def support_histogram(summary: DataFrame, column: str = "registered_support", bins: int = 20) -> DataFrame:
    """(rank, bin, assessed, flagged, unassessed): bins of equal width over 0 to 1."""
    at = F.when(F.col(column).isNotNull(), F.least(F.floor(F.col(column) * bins), F.lit(bins - 1))).cast("int")
    return summary.groupBy("rank", at.alias("bin")).agg(F.count(column).alias("assessed"), F.count_if(F.col("status") == "discordant").alias("flagged"), F.count_if(F.col(column).isNull()).alias("unassessed"))

