"""Sequence expressions: complement, windows, splicing, translation and protein properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import as_col

# IUPAC nucleotide codes and their complements, position by position.
NUCLEOTIDES = "ACGTRYMKBDHVNacgtrymkbdhvn"
COMPLEMENTS = "TGCAYRKMVHDBNtgcayrkmvhdbn"

# Standard genetic code in the customary T, C, A, G order of codon positions.
CODON_BASES = "TCAG"
CODON_RESIDUES = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

# Average masses (Da) of free amino acids, and of water.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
AMINO_ACID_MASS = {
    "A": 89.0932, "C": 121.1582, "D": 133.1027, "E": 147.1293, "F": 165.1891,
    "G": 75.0666, "H": 155.1546, "I": 131.1729, "K": 146.1876, "L": 131.1729,
    "M": 149.2113, "N": 132.1179, "P": 115.1305, "Q": 146.1445, "R": 174.201,
    "S": 105.0926, "T": 119.1192, "V": 117.1463, "W": 204.2252, "Y": 181.1885,
}
WATER_MASS = 18.0153

# Bjellqvist pK table (side chains, termini, terminus overrides by end residue).
PK_POSITIVE = {"K": 10.0, "R": 12.0, "H": 5.98}
PK_NEGATIVE = {"D": 4.05, "E": 4.45, "C": 9.0, "Y": 10.0}
PK_N_TERMINUS = 7.5
PK_C_TERMINUS = 3.55
PK_N_TERMINUS_BY_RESIDUE = {"A": 7.59, "M": 7.0, "S": 6.93, "P": 8.36, "T": 6.82, "V": 7.44, "E": 7.7}
PK_C_TERMINUS_BY_RESIDUE = {"D": 4.55, "E": 4.75}


def reverse_complement(sequence: Column | str) -> Column:
    return F.reverse(F.translate(as_col(sequence), NUCLEOTIDES, COMPLEMENTS))


def closed_substring(sequence: Column | str, start: Column | str, end: Column | str) -> Column:
    """1-based closed slice clamped to the sequence; NULL when nothing is left."""
    seq = as_col(sequence)
    first = F.greatest(F.lit(1).cast("long"), as_col(start).cast("long"))
    last = F.least(F.length(seq).cast("long"), as_col(end).cast("long"))
    return F.when(last >= first, F.substr(seq, first.cast("int"), (last - first + 1).cast("int")))


def drop_terminal_stop(protein: Column | str) -> Column:
    return F.rtrim(as_col(protein), F.lit("*"))


def translate_codons(cds: Column | str, unknown: str = "X") -> Column:
    """Residues of complete codons, standard code; unknown codons give ``unknown``.

    The sequence is cut into codons in one pass; a codon is its number in base four.
    """

    def digit(codon: Column, place: int) -> Column:
        return F.instr(F.lit(CODON_BASES), F.substr(codon, F.lit(place), F.lit(1))) - 1

    def residue(codon: Column) -> Column:
        digits = [digit(codon, place) for place in (1, 2, 3)]
        number = digits[0] * 16 + digits[1] * 4 + digits[2]
        return F.when(F.least(*digits) >= 0, F.substr(F.lit(CODON_RESIDUES), number + 1, F.lit(1))).otherwise(unknown)

    codons = F.regexp_extract_all(F.upper(as_col(cds)), F.lit("(?s).{3}"), F.lit(0))
    return F.array_join(F.transform(codons, residue), "")


def residue_counts(sequence: Column) -> Column:
    """Array with the number of each residue of ``RESIDUES``."""
    return F.array(*[F.length(sequence) - F.length(F.replace(sequence, F.lit(r), F.lit(""))) for r in RESIDUES])


# Halvings of the range 0 to 14 of the acidity, and the middle of what is left of it.
HALVINGS = [14.0 / 2**i for i in range(1, 41)]
LAST_HALF = 14.0 / 2**41


def isoelectric_point(sequence: Column, counts: Column) -> Column:
    """Theoretical pI by bisection of the charge at an acidity; NULL for empty sequences."""

    def of_end(end: Column, by_residue: dict[str, float], other: float) -> Column:
        found = F.lit(other)
        for residue, pk in by_residue.items():
            found = F.when(end == residue, pk).otherwise(found)
        return found

    n_pk = of_end(F.left(sequence, F.lit(1)), PK_N_TERMINUS_BY_RESIDUE, PK_N_TERMINUS)
    c_pk = of_end(F.right(sequence, F.lit(1)), PK_C_TERMINUS_BY_RESIDUE, PK_C_TERMINUS)

    def charge(ph: Column, facts: Column) -> Column:
        def share(exponent: Column) -> Column:
            return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), exponent))

        terms = [facts["n"][RESIDUES.index(r)] * share(ph - F.lit(pk)) for r, pk in PK_POSITIVE.items()]
        terms += [-facts["n"][RESIDUES.index(r)] * share(F.lit(pk) - ph) for r, pk in PK_NEGATIVE.items()]
        return sum([*terms[1:], share(ph - facts["first"]), -share(facts["last"] - ph)], terms[0])

    def halve(state: Column, half: Column) -> Column:
        higher = state["low"] + half
        return state.withField("low", F.when(charge(higher, state) > 0, higher).otherwise(state["low"]))

    start = F.struct(F.lit(0.0).alias("low"), counts.alias("n"), n_pk.alias("first"), c_pk.alias("last"))
    found = F.aggregate(F.array(*map(F.lit, HALVINGS)), start, halve, lambda state: state["low"] + F.lit(LAST_HALF))
    return F.when(F.length(sequence) > 0, found)


def with_protein_properties(df: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Add molecular weight, theoretical pI and a quality label for a protein column."""
    raw = F.rtrim(F.upper(F.col(sequence)), F.lit("*"))
    standard = F.regexp_replace(raw, f"[^{RESIDUES}]", "")
    n = F.length("_standard").cast("double")
    free_mass = sum((F.col("_counts")[RESIDUES.index(r)] * F.lit(mass) for r, mass in AMINO_ACID_MASS.items()), F.lit(0.0))
    status = (
        F.when(n == 0, F.lit("NO_STANDARD_RESIDUES"))
        .when(F.length("_standard") != F.length(raw), F.lit("NON_STANDARD_RESIDUES_REMOVED"))
        .otherwise(F.lit("PASS"))
    )
    return (
        df.withColumn("_standard", standard)
        .withColumn("_counts", residue_counts(F.col("_standard")))
        .withColumn("molecular_weight_da", F.when(n > 0, free_mass - (n - 1) * F.lit(WATER_MASS)))
        .withColumn("theoretical_pi", isoelectric_point(F.col("_standard"), F.col("_counts")))
        .withColumn("protein_property_qc", status)
        .drop("_standard", "_counts")
    )


def match_sequence_ids(ids: DataFrame, sequences: DataFrame, key: str = "transcript_id") -> DataFrame:
    """Resolve ids to sequence ids: exact, prefix removed, prefix added, then a unique ``id|...`` record.

    Returns ``key, seq_id`` with NULL ``seq_id`` for unresolved ids, so that callers can refuse them.
    """
    prefix = "transcript:"
    wanted = ids.select(key).distinct()
    bare = F.when(F.startswith(F.col(key), F.lit(prefix)), F.substr(F.col(key), F.lit(len(prefix) + 1)))
    tries = F.array(
        F.struct(F.lit(1).alias("rank"), F.col(key).alias("name")),
        F.struct(F.lit(2).alias("rank"), F.coalesce(bare, F.col(key)).alias("name")),
        F.struct(F.lit(3).alias("rank"), F.concat(F.lit(prefix), F.col(key)).alias("name")),
        F.struct(F.lit(4).alias("rank"), F.col(key).alias("name")),
    )
    known = sequences.select("seq_id")
    exact = known.select(F.lit(False).alias("_by_head"), F.col("seq_id").alias("_name"), "seq_id")
    heads = (
        known.groupBy(F.substring_index("seq_id", "|", 1).alias("_name"))
        .agg(F.count("*").alias("_n"), F.min("seq_id").alias("seq_id"))
        .where("_n = 1")
        .select(F.lit(True).alias("_by_head"), "_name", "seq_id")
    )
    exploded = wanted.select(key, F.inline(tries)).select(
        key, "rank", F.col("name").alias("_name"), (F.col("rank") == 4).alias("_by_head")
    )
    found = exploded.join(exact.unionByName(heads), ["_by_head", "_name"], "left").where("seq_id is not null")
    best = found.groupBy(key).agg(F.min_by("seq_id", "rank").alias("seq_id"))
    return wanted.join(best, key, "left")
