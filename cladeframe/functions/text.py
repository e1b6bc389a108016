"""Column functions on identifiers, names, numbers held as text, sequences and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Identifiers, the gene suffix, taxids, run accessions and missing traits in the input files.
SAFE = r"^[A-Za-z0-9][A-Za-z0-9_.-]*\z"
GENE = r"^([A-Za-z0-9][A-Za-z0-9_.-]*)_g[0-9]+\z"
TAXID = r"^0*([1-9][0-9]*)(?:\.0+)?\z"
ACCESSION = r"(?i)[DES]RR[0-9]+"
NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*\z"
MISSING = ("", "NA", "NaN", "nan")
AMINO = "ACDEFGHIKLMNPQRSTVWY"
#: Standard genetic code, codons in TCAG order.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def is_safe(x: Column) -> Column:
    return F.coalesce(x.rlike(SAFE), F.lit(False))


def sample_of_gene(gene: Column) -> Column:
    """The sample part of a gene id; null if it is none."""
    return F.nullif(F.regexp_extract(gene, GENE, 1), F.lit(""))


def species_id(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))


def analysis_sample_id(name: Column, run: Column) -> Column:
    return F.concat_ws("_", species_id(name), run)


def odb_species(sample: Column) -> Column:
    return F.replace(sample, F.lit("-"), F.lit("_"))


def clean_scientific_name(name: Column) -> Column:
    """No brackets or commas, hyphens for :/#, single spaces; one-word names get _XXX."""
    x = F.regexp_replace(name, r"[\[\](){}',\"]", "")
    x = F.trim(F.regexp_replace(F.regexp_replace(x, r"[:/#]", "-"), r"\s+", " "))
    return F.when(F.contains(x, F.lit(" ")) | (x == ""), x).otherwise(F.concat(x, F.lit("_XXX")))


def canonical_taxid(x: Column) -> Column:
    """42 or 42.0 as long; null for blank and for what isn't a positive integer (see taxid_invalid)."""
    return F.try_to_number(F.nullif(F.regexp_extract(F.trim(x), TAXID, 1), F.lit("")), F.lit("9999999999999999999")).cast("long")


def taxid_invalid(x: Column) -> Column:
    return F.coalesce(F.trim(x) != "", F.lit(False)) & canonical_taxid(x).isNull()


def parsed(x: Column) -> Column:
    """A number held as text, which may be infinite or negative."""
    return F.when(x.rlike(NUMBER), F.trim(x).try_cast("double"))


def finite(value: Column, nonnegative: bool = True) -> Column:
    ok = ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(ok & (value >= 0) if nonnegative else ok, value)


def number(x: Column, nonnegative: bool = True) -> Column:
    """A finite number held as text, else null; so are negative ones unless allowed."""
    return finite(parsed(x), nonnegative)


def exact(x: Column, scale: int = 18) -> Column:
    """Decimal of a finite number held as text or double: sums of these don't depend on order. Null for what is no number. A number that the
    decimal can't hold, too large or too small beside 0, is an error and never becomes null or 0; operators.sums adds
    those."""
    value = x.try_cast("double")
    size = F.abs(value)
    fits = (value == 0) | ((size >= float(f"1e-{scale}")) & (size < float(f"1e{38 - scale}")))
    kept = x.try_cast(f"decimal(38,{scale})")
    wrong = F.raise_error(F.concat(F.lit("no exact decimal of "), x.cast("string"))).cast(f"decimal(38,{scale})")
    return F.when(value.isNull(), None).when(F.isnan(value) | fits, kept).otherwise(wrong)


def decimal_ceiling(fraction: str, total: Column) -> Column:
    """ceil(fraction * total) in decimals: 0.07 of 100 is 7."""
    return F.ceil(F.lit(fraction).cast("decimal(20,12)") * total.cast("decimal(18,0)")).cast("long")


def is_close(a: Column, b: Column, relative: float = 1e-9, absolute: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def percent(part: Column, whole: Column) -> Column:
    return F.format_number(part.cast("decimal(38,10)") * 100 / whole, 2)


def digest(*cols: str) -> Column:
    """SHA-256 of the canonical JSON of columns, in the given order."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def translated(seq: Column, stop: str = "*", to_stop: bool = False) -> Column:
    """Protein of a coding sequence, X for codons that aren't clear; a rest of one or two bases is left out."""
    codons = [a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"]
    code = F.create_map(*[F.lit(x) for pair in zip(codons, CODE.replace("*", stop)) for x in pair])
    dna = F.translate(F.upper(seq), "U", "T")
    one = lambda i: F.coalesce(F.try_element_at(code, F.substring(dna, i, F.lit(3))), F.lit("X"))
    whole = F.when(F.length(seq) < 3, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(seq) - 2, F.lit(3)), one), ""))
    return F.substring_index(whole, stop, 1) if to_stop else whole


def normalized_protein(seq: Column) -> Column:
    """Without one terminal stop; null unless the rest is capital letters."""
    rest = F.regexp_replace(seq, r"\*\z", "")
    return F.when(rest.rlike(r"^[A-Z]+\z"), rest)


def known_residues(seq: Column) -> Column:
    return F.length(seq) - F.length(F.regexp_replace(seq, f"[{AMINO}]", ""))


def unknown_as_x(seq: Column) -> Column:
    return F.regexp_replace(seq, f"[^{AMINO}]", "X")


def sequence_problem(seq: Column, minimum: int, most_unknown: float) -> Column:
    """short_protein, ambiguous_protein or null."""
    known = known_residues(seq)
    return F.when(known < minimum, "short_protein").when(1 - known / F.length(seq) > most_unknown, "ambiguous_protein")


def aligned_columns(seq: Column, columns: Column) -> Column:
    """The given columns, counted from 0, of an aligned sequence."""
    return F.array_join(F.transform(columns, lambda i: F.substring(seq, i + 1, F.lit(1))), "")


def unknown_as_gap(seq: Column, unknown: str = "X?") -> Column:
    return F.translate(seq, unknown, "-" * len(unknown))


def cigar_pairs(cigar: Column, query_start: Column, target_start: Column) -> Column:
    """array<struct<op, n, q, t>>: the runs of a CIGAR text with the query and target position where each begins."""
    op = "struct<op:string,n:int,q:int,t:int>"
    start = F.struct(query_start.cast("int").alias("q"), target_start.cast("int").alias("t"), F.array().cast(f"array<{op}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        n, kind = F.regexp_extract(x, r"^([0-9]+)", 1).cast("int"), F.right(x, F.lit(1))
        one = F.struct(kind.alias("op"), n.alias("n"), acc["q"].alias("q"), acc["t"].alias("t"))
        return F.struct(
            (acc["q"] + F.when(kind.isin("M", "I", "=", "X"), n).otherwise(0)).alias("q"),
            (acc["t"] + F.when(kind.isin("M", "D", "=", "X"), n).otherwise(0)).alias("t"),
            F.concat(acc["out"], F.array(one)).alias("out"),
        )

    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"[0-9]+[MIDX=]"), F.lit(0)), start, step, lambda acc: acc["out"])


def aligned_positions(cigar: Column, query_start: Column, target_start: Column) -> Column:
    """array<struct<q, t>>: query and target positions that a CIGAR text aligns."""
    runs = F.filter(cigar_pairs(cigar, query_start, target_start), lambda r: r["op"].isin("M", "=", "X"))
    pairs = lambda r: F.transform(F.sequence(F.lit(0), r["n"] - 1), lambda i: F.struct((r["q"] + i).alias("q"), (r["t"] + i).alias("t")))
    return F.flatten(F.transform(runs, pairs))


def gapped(query: Column, target: Column, query_start: Column, query_end: Column, target_start: Column, target_end: Column, cigar: Column, protein: bool = False) -> Column:
    """struct<query, target, problem>: both sequences as a CIGAR text (M, I, D, = and X) aligns them, with - for gaps. Coordinates
    count from 1 and run backwards on the reverse strand, whose sequence is complemented and turned. problem: reversed_protein,
    invalid_cigar, or coordinates (the runs don't end where the coordinates or the sequences do); the strings are null then."""
    runs = F.transform(
        F.regexp_extract_all(cigar, F.lit("([0-9]+[MID=X])"), F.lit(1)), lambda r: F.struct(F.regexp_extract(r, "([0-9]+)", 1).cast("int").alias("n"), F.right(r, F.lit(1)).alias("op"))
    )
    backwards = lambda a, b: a > b

    def part(seq: Column, a: Column, b: Column) -> Column:
        cut = F.substring(seq, F.least(a, b), F.abs(b - a) + 1)
        return F.when(backwards(a, b), F.reverse(F.translate(cut, "ACGT", "TGCA"))).otherwise(cut)

    q, t = part(query, query_start, query_end), part(target, target_start, target_end)
    start = F.struct(F.lit(0).alias("q"), F.lit(0).alias("t"), F.array().cast("array<struct<q:int,t:int,n:int,op:string>>").alias("runs"))

    def step(s: Column, r: Column) -> Column:
        row = F.struct(s["q"].alias("q"), s["t"].alias("t"), r["n"].alias("n"), r["op"].alias("op"))
        return F.struct((s["q"] + F.when(r["op"] == "D", 0).otherwise(r["n"])).alias("q"), (s["t"] + F.when(r["op"] == "I", 0).otherwise(r["n"])).alias("t"), F.concat(s["runs"], F.array(row)).alias("runs"))

    def strings(x: Column) -> Column:
        placed, own_q, own_t = x["walk"]["runs"], x["q"], x["t"]
        side = lambda seq, at, gap: F.array_join(F.transform(placed, lambda r: F.when(r["op"] == gap, F.repeat(F.lit("-"), r["n"])).otherwise(F.substring(seq, r[at] + 1, r["n"]))), "")
        ends = lambda walked, a, b, seq: (walked == F.abs(b - a) + 1) & (walked == F.length(seq))
        fits = ends(x["walk"]["q"], query_start, query_end, own_q) & ends(x["walk"]["t"], target_start, target_end, own_t)
        odd = F.when(F.lit(protein) & (backwards(query_start, query_end) | backwards(target_start, target_end)), "reversed_protein").when(~cigar.rlike(r"^([0-9]+[MID=X])+\z"), "invalid_cigar").when(~fits, "coordinates")
        return F.struct(F.when(odd.isNull(), side(own_q, "q", "D")).alias("query"), F.when(odd.isNull(), side(own_t, "t", "I")).alias("target"), odd.alias("problem"))

    # computed once, however often it is used below
    return F.element_at(F.transform(F.array(F.struct(q.alias("q"), t.alias("t"), F.aggregate(runs, start, step).alias("walk"))), strings), 1)


def accessions(x: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(ACCESSION), F.lit(0)), F.upper))


def header_words(header: Column, pair: str = " ", value: str = ":") -> Column:
    """map of the key:value words of a header."""
    words = F.filter(F.split(header, pair), lambda w: F.contains(w, F.lit(value)))
    return F.str_to_map(F.array_join(words, pair), F.lit(pair), F.lit(value))


def label_parts(label: Column) -> Column:
    """struct<order, family, genus, rest> of order_family_genus_rest."""
    parts = F.split(label, "_", 4)
    return F.struct(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(("order_name", "family", "genus", "rest"))])


def trait_value(x: Column) -> Column:
    """Null for missing tokens."""
    y = F.trim(x)
    return F.when(y.isin(*MISSING), F.lit(None)).otherwise(y)


def joined_sorted(x: str, separator: str = ";") -> Column:
    """Aggregate: distinct values, sorted, in one text."""
    return F.array_join(F.array_sort(F.collect_set(x)), separator)
