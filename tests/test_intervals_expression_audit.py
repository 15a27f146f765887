import hashlib
import os
import random

import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from cladegrid.operators import audit, expression, intervals
from cladegrid.operators.expect import QualityError, namespace_overlap
from cladegrid.plans import genomics
from cladegrid.sources import delimited


def random_intervals(seed, n=600):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randint(1, 3000)
        out.append((f"f{i}", "hot" if rng.random() < 0.5 else f"s{rng.randint(0, 5)}", start, start + rng.choice([0, 3, 50, 900])))
    return out


@pytest.mark.parametrize("width", [1, 100, 10**6])
def test_gaps_by_brute_force(spark, width):
    data = random_intervals(1)
    df = spark.createDataFrame(data, "id string, seq string, start long, end long")
    total = {r.seq: (r.s, r.n) for r in intervals.gaps(df, ["seq"], width=width).groupBy("seq").agg(F.sum("gap").alias("s"), F.sum("n").alias("n")).collect()}
    for seq in {d[1] for d in data}:
        own = sorted((s, e) for _, q, s, e in data if q == seq)
        assert total[seq] == (sum(max(0, b[0] - a[1] - 1) for a, b in zip(own, own[1:])), len(own))


@pytest.mark.parametrize("width", [7, 400, 10**6])
def test_overlaps_by_brute_force(spark, width):
    data = random_intervals(2, 300)
    features = spark.createDataFrame(data, "gene string, seq string, start long, end long")
    windows = features.selectExpr("gene AS w", "gene", "seq", "start - 40 AS start", "start - 1 AS end")
    expected = {
        f: sorted(g for g, q2, s2, e2 in data if q2 == q and g != f and not (e2 < s - 40 or s2 > s - 1)) for f, q, s, _ in data
    }
    counts = {r.w: r.overlap_count for r in intervals.overlap_counts(windows, features, "seq", "w", "gene", width=width).collect()}
    assert counts == {k: len(v) for k, v in expected.items()}
    lists = by(intervals.overlap_lists(windows, features, "seq", "w", "gene", width=width), "w")
    assert {k: v["overlap_ids"] for k, v in lists.items()} == {k: ";".join(v) or None for k, v in expected.items()}
    assert {k: v["overlap_count"] for k, v in lists.items()} == counts


@pytest.mark.parametrize("width", [1, 7, 1024])
def test_points_in_ranges_by_brute_force(spark, width):
    rng = random.Random(5)
    spans = [(f"r{i}", "ab"[i % 2], s, s + rng.choice([-1, 0, 1, 15, 16, 300, 9000])) for i in range(80) for s in [rng.randint(-500, 9000)]]
    spots = [(f"p{i}", "ab"[i % 2], rng.randint(-600, 20000)) for i in range(120)] + [("none", "a", None)]
    ranges = spark.createDataFrame([*spans, ("open", "a", None, 5)], "r string, seq string, lo long, hi long")
    points = spark.createDataFrame(spots, "p string, seq string, at long")
    found = [(x.r, x.p) for x in intervals.points_in_ranges(ranges, points, "seq", "lo", "hi", "at", width=width).collect()]
    assert sorted(found) == sorted((r, p) for r, q, lo, hi in spans for p, q2, at in spots if q == q2 and at is not None and lo <= at <= hi)


def test_cells_of_a_range_are_few_and_exact(spark):
    """A range over 10 million positions takes a few dozen cells, and they hold each of its blocks once."""
    bounds = [(0, 1), (3, 4), (5, 5 + 4**4), (-7, 90), (1, 10_000_001)]
    cells = spark.createDataFrame(bounds, "a long, b long").select("a", "b", intervals._range_cells(F.col("a"), F.col("b")).alias("c")).collect()
    for r in cells:
        assert len(r.c) <= 6 * 13 and sum(4**c.level for c in r.c) == r.b - r.a
        if r.b - r.a < 1000:
            assert sorted(x for c in r.c for x in range(c.cell * 4**c.level, (c.cell + 1) * 4**c.level)) == list(range(r.a, r.b))


def test_no_ranges_or_points(spark):
    none = spark.createDataFrame([], "gene string, seq string, start long, end long")
    one = spark.createDataFrame([("g", "s", 1, 5)], "gene string, seq string, start long, end long")
    for windows, features in ((none, one), (one, none), (none, none)):
        assert intervals.overlap_pairs(windows.withColumn("w", F.col("gene")), features, "seq", "w", "gene").count() == 0


def test_structure(spark):
    features = spark.createDataFrame(
        [
            ("SpA", "gene", "c1", 31, 195, "+", "GeneA1", None), ("SpA", "mRNA", "c1", 31, 195, "+", "A1.1", "GeneA1"),
            ("SpA", "exon", "c1", 121, 195, "+", None, "A1.1,other"), ("SpA", "exon", "c1", 31, 105, "+", None, "A1.1"),
            ("SpA", "CDS", "c1", 34, 105, "+", None, "A1.1"), ("SpA", "five_prime_UTR", "c1", 31, 33, "+", None, "A1.1"),
        ],
        "species_id string, feature string, seqid string, start long, end long, strand string, id string, parent string",
    )
    canonical = spark.createDataFrame(
        [("SpA", "G", "GeneA1", "A1.1", "SpA__GeneA1", "x", 1, 2, "-", 1, 2, 24, 72), ("SpA", "G", "GeneA2", "A2.1", "SpA__GeneA2", "c2", 5, 9, "-", None, None, 10, 30), ("SpA", "G", "N", "N.1", "SpA__N", "c2", 5, 9, "-", 1, 2, 1, 3)],
        "species_id string, group string, gene_id string, transcript_id string, stable_id string, chromosome string, gene_start long, gene_end long, strand string, transcript_start long, transcript_end long, protein_length long, cds_length long",
    )
    members = spark.createDataFrame([("SpA__GeneA1", "S1"), ("SpA__GeneA2", None)], "stable_id string, subfamily string")
    table = genomics.gene_structure(features, canonical, members)
    found = by(table, "stable_id")
    a, b = found["SpA__GeneA1"], found["SpA__GeneA2"]
    assert (a["chromosome"], a["strand"], a["gene_length"], a["transcript_span"], a["cds_length"]) == ("c1", "+", 165, 165, 72)
    assert (a["exon_count"], a["mean_exon_length"], a["intron_count"], a["total_intron_length"], a["mean_intron_length"]) == (2, 75.0, 1, 15, 15.0)
    assert (a["five_prime_utr_length"], a["structure_qc"]) == (3, "PASS")
    assert (b["gene_length"], b["transcript_span"], b["exon_count"], b["mean_exon_length"], b["mean_intron_length"], b["structure_qc"]) == (5, None, 0, None, 0.0, "MISSING_EXON_OR_CDS")
    assert len(found) == 2
    summary = by(genomics.structure_summary(table), "group_field", "group_value", "metric")
    assert summary[("group", "G", "gene_length")]["n"] == 2 and summary[("subfamily", None, "gene_length")]["sd"] is None


def test_positions(spark):
    members = spark.createDataFrame([("SpA", "c1", "a", 1, 3), ("SpA", "c1", "b", None, 3), ("SpB", "c1", "c", 1, 3)], "species_id string, chromosome string, stable_id string, gene_start long, gene_end long")
    lengths = spark.createDataFrame([("SpA", "c1", 100)], "species_id string, chromosome string, chromosome_length long")
    placed, density = genomics.chromosome_positions(members, lengths)
    found = by(placed, "stable_id")
    assert (found["a"]["midpoint"], found["a"]["relative_position"], found["a"]["coordinate_qc"]) == (2.0, 0.02, "PASS")
    assert found["b"]["coordinate_qc"] == found["c"]["coordinate_qc"] == "MISSING_COORDINATE_OR_CHROMOSOME"
    assert rows(density) == {("SpA", "c1", 100, 1, 10000.0)}
    assert genomics.chromosome_positions(members, lengths, ["SpB"])[0].count() == 1


def test_promoters(spark):
    genome = spark.createDataFrame([("Sp", "c1", "AACCGGTTAACCGGTTACGT")], "species_id string, chromosome string, sequence string")
    canonical = spark.createDataFrame(
        [("Sp", "p", "Sp__p", "c1", 9, 12, "+"), ("Sp", "m", "Sp__m", "c1", 3, 18, "-"), ("Sp", "q", "Sp__q", "c9", 1, 2, "+"), ("Sp", "s", "Sp__s", "c1", 1, 2, "?")],
        "species_id string, gene_id string, stable_id string, chromosome string, gene_start long, gene_end long, strand string",
    )
    genes = canonical.selectExpr("species_id", "chromosome", "gene_id", "gene_start AS start", "gene_end AS end")
    coordinates, sequences = genomics.promoters(canonical, canonical, genome, genes, 4, 1)
    found = by(coordinates, "stable_id")
    p, m = found["Sp__p"], found["Sp__m"]
    assert (p["promoter_start_1based"], p["promoter_end_1based"], p["promoter_length"], p["promoter_qc"], p["tss_1based"]) == (5, 9, 5, "PASS", 9)
    assert (p["overlap_gene_count"], p["overlap_gene_ids"]) == (1, "m")
    assert (m["promoter_start_1based"], m["promoter_end_1based"], m["promoter_qc"]) == (18, 20, "TRUNCATED_AT_CHROMOSOME_BOUNDARY")
    assert (m["overlap_gene_count"], m["overlap_gene_ids"], m["truncated_at_chr_boundary"]) == (0, None, True)
    assert found["Sp__q"]["promoter_qc"] == "CHROMOSOME_NOT_FOUND" and found["Sp__s"]["promoter_qc"] == "INVALID_STRAND"
    assert found["Sp__s"]["promoter_length"] is None
    assert rows(sequences) == {("Sp__p", "GGTTA"), ("Sp__m", "ACG")}


MEMBERS = "stable_id string, species_id string, gene_id string, subfamily string"


def test_imported_expression(spark):
    members = spark.createDataFrame([("SpA__A", "SpA", "A", None), ("SpB__B", "SpB", "B", None)], MEMBERS)
    raw = spark.createDataFrame([("SpA__A", "2.5", None), ("SpZ__Z", "1", "1")], "stable_id string, s1 string, s2 string")
    matrix, samples = delimited.expression_matrix(raw, members)
    assert samples == ["s1", "s2"]
    tables = genomics.imported_expression(matrix, samples, members)
    long = by(tables["long"], "stable_id", "sample_id")
    assert (long[("SpA__A", "s1")]["measurement_status"], long[("SpA__A", "s1")]["detected"]) == ("OBSERVED", True)
    assert long[("SpA__A", "s2")]["detected"] is None and long[("SpB__B", "s1")]["measurement_status"] == "MISSING_IN_INPUT"
    assert rows(tables["matrix"], "stable_id", "expression_data_status") == {("SpA__A", "PARTIAL_MISSING"), ("SpB__B", "MISSING")}
    b = by(tables["summary"], "stable_id")["SpB__B"]
    assert (b["samples_available"], b["expression_detected_samples"], b["expression_detected_fraction"], b["median_expression"]) == (0, 0, None, None)
    assert by(tables["heatmap"], "stable_id", "sample_id")[("SpA__A", "s1")]["zscore_log2"] == 0.0
    with pytest.raises(QualityError, match="EXPRESSION_VALUE"):
        genomics.imported_expression(matrix.withColumn("s1", F.lit(-1.0)), samples, members)
    with pytest.raises(Exception, match="not a number"):
        delimited.expression_matrix(raw.withColumn("s1", F.lit("abc")), members)[0].collect()


def test_abundance_expression(spark):
    members = spark.createDataFrame([("SpA__G1", "SpA", "G1", None), ("SpA__G2", "SpA", "G2", None), ("SpB__G1", "SpB", "G1", None)], MEMBERS)
    samples = spark.createDataFrame([("a1", "SpA"), ("b1", "SpB")], "sample_id string, species_id string")
    abundance = spark.createDataFrame([("a1", "G1", 1.5), ("a1", "G1", 2.0), ("a1", "zz", 9.0), ("b1", "G1", 8.0)], "sample_id string, gene_id string, tpm double")
    tables = genomics.abundance_expression(abundance, samples, members, members, ["a1", "b1"])
    long = by(tables["long"], "stable_id", "sample_id")
    seen = {k: (v["expression_value"], v["measurement_status"]) for k, v in long.items()}
    assert seen[("SpA__G1", "a1")] == (3.5, "MEASURED") and seen[("SpA__G2", "a1")] == (0.0, "ASSAYED_ZERO")
    assert seen[("SpA__G1", "b1")] == (None, "NOT_APPLICABLE") and seen[("SpB__G1", "b1")] == (8.0, "MEASURED")
    g2 = by(tables["summary"], "stable_id")["SpA__G2"]
    assert (g2["samples_available"], g2["measured_samples"], g2["assayed_zero_samples"], g2["expression_detected_samples"]) == (1, 0, 1, 0)
    with pytest.raises(QualityError, match="GENE_UNIQUE_IN_SPECIES"):
        genomics.abundance_expression(abundance, samples, members.unionByName(members), members, ["a1"])


def test_row_zscores_of_a_heavy_row(spark):
    df = spark.range(3000).selectExpr("IF(id < 2000, 'hot', CAST(id AS STRING)) AS g", "CAST(id % 7 AS DOUBLE) AS expression_value")
    found = expression.row_zscores(df, "g").groupBy("g").agg(F.avg("zscore_log2").alias("m"), F.stddev_pop("zscore_log2").alias("s"), F.count("*").alias("n"))
    hot = by(found, "g")["hot"]
    assert hot["n"] == 2000 and hot["m"] == pytest.approx(0, abs=1e-9) and hot["s"] == pytest.approx(1.0)
    assert found.agg(F.sum("n")).collect()[0][0] == 3000


def test_namespace_overlap(spark):
    a, b = (spark.createDataFrame([(x,) for x in ids], "id string") for ids in ("xy", "xy"))
    assert rows(namespace_overlap({"cds": a, "protein": b}, "id")) == {("cds", "protein", 2, 2, 2, "PASS")}


# --- audits ---

GATES = audit.Acceptance(min_genomes=2, max_genomes=2, min_positive=1, min_negative=1, chromosome_level_policy="block")


def panel_files(folder):
    texts = {"genome": ">Chr1\nATGAAGATG\n", "gff3": "##gff-version 3\nChr1\tt\tgene\t1\t9\t.\t+\t.\tID=Gene1\n", "protein": ">Gene1\nMKM\n", "cds": ">Gene1\nATGAAGATG\n"}
    panel, files = [], {}
    for number, group in ((1, "A"), (2, "B")):
        row = {
            "species_id": f"Rice{number:02d}", "species_name": "Oryza", "group": group, "include": "true", "representative": "yes" if number == 1 else "No",
            "input_kind": "assembled_genome", "assembly_accession": "T.1", "assembly_level": "chromosome", "annotation_version": "v1", "coordinate_system": "T.1",
        }
        for field, text in texts.items():
            path = os.path.join(folder, f"Rice{number:02d}.{field}")
            with open(path, "w") as handle:
                handle.write(text)
            files[path] = field
            row[field], row[f"{field}_sha256"] = path, hashlib.sha256(text.encode()).hexdigest().upper()
        panel.append(row)
    truth = [("Rice01", "Gene1", "POSITIVE", "e", "r"), ("Rice02", "Other", "negative", "e", "r"), ("Nowhere", "TODO_1", "?", "e", "r")]
    return panel, files, truth


def run_audit(spark, panel, files, truth, gates=GATES):
    columns = list(audit.PANEL_COLUMNS)
    raw = spark.createDataFrame([tuple([i + 2, *[r.get(c) for c in columns]]) for i, r in enumerate(panel)], "row_number int, " + ", ".join(f"`{c}` string" for c in columns))
    seen = audit.format_states(spark, {p: f for p, f in files.items() if os.path.exists(p)})
    from cladegrid.sources.sinks import read_files

    state = read_files(spark, [p for p in files if os.path.exists(p)]).join(seen.drop("field"), "path", "left")
    table = spark.createDataFrame(truth, "species_id string, gene_id string, expected_status string, evidence string, reviewer string")
    checks, states, status = audit.readiness(audit.parse_panel(raw), table, state, gates)
    failed = {(r.check_id, r.item_id, r.scope) for r in checks.collect() if r.status not in ("PASS", "INFO")}
    return status.collect()[0], failed, states


def test_ready_panel(spark, folder):
    status, failed, states = run_audit(spark, *panel_files(folder))
    assert failed == set() and (status.overall_status, status.blocking_failures, status.warnings) == ("READY", 0, 0)
    assert rows(states, "format_state") == {("PASS",), ("PASS_GFF3",)} and states.where("checksum_match").count() == 8


def test_missing_wrong_and_malformed_files(spark, folder):
    panel, files, truth = panel_files(folder)
    os.unlink(panel[1]["protein"])
    open(panel[0]["genome"], "w").write("ACGT\n")
    open(panel[1]["gff3"], "w").write("# only comments\n")
    status, failed, _ = run_audit(spark, panel, files, truth)
    assert status.overall_status == "BLOCKED"
    assert failed == {
        ("BMG110", "Rice02", "species.protein"), ("BMG112", "Rice01", "species.genome"), ("BMG113", "Rice01", "species.genome"),
        ("BMG112", "Rice02", "species.gff3"), ("BMG113", "Rice02", "species.gff3"),
    }


def test_panel_and_truth_rules(spark, folder):
    panel, files, truth = panel_files(folder)
    panel[0] |= {"input_kind": "reference_aligned_sample", "assembly_level": "scaffold", "outgroup_species_id": "Gone", "annotation_version": None}
    panel[1] |= {"representative": "true", "group": "A"}
    panel.append({"species_id": "a__b", "species_name": "x", "include": "maybe", "cds_sha256": "12"})
    status, failed, _ = run_audit(spark, panel, files, [("Else", "g", "MAYBE", "e", "r")])
    assert status.overall_status == "BLOCKED" and status.warnings == 1
    assert {c for c, _, _ in failed} == {"BMG031", "BMG040", "BMG041", "BMG042", "BMG100", "BMG101", "BMG102", "BMG103", "BMG062", "BMG063", "BMG064", "BMG065"}
    assert ("BMG031", "row_4", "species_row") in failed


def test_warnings_alone_need_review(spark, folder):
    panel, files, truth = panel_files(folder)
    panel[0]["assembly_level"] = "contig"
    gates = audit.Acceptance(min_genomes=2, max_genomes=2, min_positive=1, min_negative=1)
    status, failed, _ = run_audit(spark, panel, files, truth, gates)
    assert status.overall_status == "REVIEW" and failed == {("BMG102", "Rice01", "species")}


def test_file_audit(spark, folder):
    panel, _, _ = panel_files(folder)
    empty = os.path.join(folder, "empty.fa")
    open(empty, "w").close()
    twice = os.path.join(folder, "twice.fa")
    open(twice, "w").write(">a\nA\n>a\nCC\n")
    nogene = os.path.join(folder, "n.gff3")
    open(nogene, "w").write("c\tt\tmRNA\t1\t9\t.\t+\t.\tID=x\n")
    records = [("S", "genome", panel[0]["genome"]), ("S", "gff3", panel[0]["gff3"]), ("S", "cds", empty), ("S", "protein", twice), ("T", "gff3", nogene), ("T", "hmm", panel[0]["cds"])]
    found = by(audit.audit_files(spark, records), "path")
    genome = found[panel[0]["genome"]]
    assert (genome["record_count"], genome["total_length"], genome["mean_length"], genome["status"]) == (1, 9, 9.0, "PASS")
    assert (found[panel[0]["gff3"]]["gff_gene_count"], found[panel[0]["gff3"]]["status"]) == (1, "PASS")
    assert (found[empty]["status"], found[empty]["notes"], found[empty]["size_bytes"]) == ("FAIL", "No FASTA records", 0)
    assert (found[twice]["status"], found[twice]["notes"]) == ("FAIL", "UNIQUE_SEQUENCE_ID")
    assert (found[nogene]["status"], found[nogene]["gff_transcript_count"]) == ("WARN", 1)
    assert found[panel[0]["cds"]]["record_count"] is None and found[panel[0]["cds"]]["sha256"]
