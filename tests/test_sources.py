import gzip
import os

import pytest
from conftest import by, rows

from cladegrid.functions import sequences
from cladegrid.operators import evidence, tiles
from cladegrid.plans import genomics
from cladegrid.sources import delimited, fasta, gff, hits, sinks


def write(folder, name, text, opener=open):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as handle:
        handle.write(text)
    return path


def test_separator_choice(spark, folder):
    cases = {"a.csv": ("x;y", ","), "a.tsv": ("x,y", "\t"), "a.tab": ("x", "\t"), "one.txt": ("# c,c\n\nalone\nx", "\t"), "c.txt": ("a,b\n", ","), "t.txt": ("a,b\tc", "\t")}
    assert {n: delimited.separator_of(spark, write(folder, n, text)) for n, (text, _) in cases.items()} == {n: s for n, (_, s) in cases.items()}


def test_all_string_table_with_missing_cells(spark, folder):
    path = write(folder, "m.tsv", "﻿stable_id\tv w\nA\t01\nB\tNA\nC\t\n")
    table = delimited.read_table(spark, path)
    assert rows(table) == {("A", "01"), ("B", None), ("C", None)}


def test_fasta_records(spark, folder):
    text = "\n>s1 first record\r\nACGT\r\n\r\nAC\r\n>s2\nGG\n>s3\n"
    path = write(folder, "x.fa", text)
    assert rows(fasta.read_fasta(spark, path)) == {("s1", "ACGTAC"), ("s2", "GG"), ("s3", "")}
    assert rows(fasta.fasta_lengths(spark, path)) == {("s1", 6), ("s2", 2), ("s3", 0)}
    packed = write(folder, "y.fa.gz", text, gzip.open)
    assert rows(fasta.fasta_lengths(spark, packed)) == {("s1", 6), ("s2", 2), ("s3", 0)}
    assert fasta.fasta_violations(spark, path).count() == 0
    bad = write(folder, "z.fa", "ACGT\n>s1\nA\n>s1 again\nC\n")
    assert rows(fasta.fasta_violations(spark, bad), "rule") == {("SEQUENCE_BEFORE_HEADER",), ("UNIQUE_SEQUENCE_ID",)}
    assert fasta.concat_fastas(spark, [path, packed])[1].count() == 3


def test_fasta_round_trip(spark, folder):
    df = spark.createDataFrame([("b", "A" * 130), ("a", "C" * 60), ("c", "")], "seq_id string, sequence string")
    out = os.path.join(folder, "out")
    fasta.write_fasta(df.coalesce(1), out)
    text = "".join(open(os.path.join(out, n)).read() for n in sorted(os.listdir(out)) if n.startswith("part"))
    assert text.split("\n")[:6] == [">a", "C" * 60, ">b", "A" * 60, "A" * 60, "A" * 10]
    assert rows(fasta.read_fasta(spark, out)) == rows(df)


GENE = "##gff-version 3\nchr1\tt\tgene\t1\t100\t.\t+\t.\tID=Gene1;Name=n\n"
TWO = GENE + "".join(
    f"chr1\tt\tmRNA\t1\t90\t.\t+\t.\tID=Gene1.{x};Parent=Gene1\nchr1\tt\tCDS\t1\t30\t.\t+\t0\tID=c.{x};Parent=Gene1.{x}\nchr1\tt\texon\t1\t30\t.\t+\t.\tParent=Gene1.{x}\n"
    for x in "za"
)


def features(spark, path):
    return gff.with_hierarchy(gff.read_gff(spark, path))


def test_attributes(spark, folder):
    line = 'c\ts\tmRNA\t1\t2\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; ID=a;ID=b=c; junk ; Parent=p1,p2;'
    path = write(folder, "a.gff3", line.replace(" junk", "junk") + "\n")
    row = features(spark, path).collect()[0]
    assert (row.attributes["gene_id"], row.id, row.parent) == ("g1", "b=c", "p1,p2") and "junk" not in row.attributes
    assert features(spark, path).select(gff.first_parent("parent")).collect()[0][0] == "p1"


def test_malformed_annotation_lines(spark, folder):
    lines = ["c\ts\tgene\t1\t2\t.\t+\t.", "c\ts\tgene\t 1\t2\t.\t+\t.\tID=x", "c\ts\tgene\t5\t2\t.\t+\t.\tID=x", "c\ts\tgene\tx\t2\t.\t+\t.\tID=x", "# c", "", "##FASTA"]
    path = write(folder, "bad.gff3", "\n".join(lines))
    assert rows(gff.gff_violations(spark, path), "rule") == {(r,) for r in ("NINE_COLUMNS", "PADDED_COORDINATE", "VALID_INTERVAL", "INTEGER_COORDINATE", "EMBEDDED_SEQUENCES")}
    assert gff.read_gff(spark, path).count() == 0


def test_canonical_tie_and_counters(spark, folder):
    path = write(folder, "two.gff3", TWO)
    selected, counters = genomics.select_canonical(features(spark, path))
    assert rows(selected, "gene_id", "transcript_id", "cds_length") == {("Gene1", "Gene1.a", 30)}
    assert rows(counters, "genes_with_cds", "selected_transcripts", "skipped_genes") == {(1, 1, 0)}
    kept = genomics.canonical_features(features(spark, path), selected)
    assert rows(kept, "feature", "parent") == {("gene", None), ("mRNA", "Gene1"), ("CDS", "Gene1.a"), ("exon", "Gene1.a")}


@pytest.mark.parametrize(
    "extra,rule",
    [
        ("chr1\tt\tCDS\t40\t50\t.\t+\t0\tParent=Gene1.a,Gene1.z\n", "ONE_PARENT_PER_PART"),
        ("chr1\tt\tCDS\t20\t50\t.\t+\t0\tParent=Gene1.a\n", "CDS_SEGMENTS_DISJOINT"),
        ("chr1\tt\texon\t20\t50\t.\t+\t0\tParent=none\n", "PART_PARENT_KNOWN"),
        ("chr1\tt\tmRNA\t20\t50\t.\t+\t0\tID=q;Parent=none\n", "TRANSCRIPT_PARENT_KNOWN"),
        ("chr1\tt\tgene\t20\t50\t.\t+\t0\tID=Gene1\n", "GENE_ID_UNIQUE"),
    ],
)
def test_hierarchy_rules(spark, folder, extra, rule):
    with pytest.raises(ValueError, match=rule):
        genomics.select_canonical(features(spark, write(folder, "x.gff3", TWO + extra)))


def test_canonical_map_with_sequences(spark, folder):
    text = (
        "c1\tt\tgene\t1\t12\t.\t+\t.\tID=P\nc1\tt\tmRNA\t1\t12\t.\t+\t.\tID=P.1;Parent=P\nc1\tt\tCDS\t1\t6\t.\t+\t0\tParent=P.1\nc1\tt\tCDS\t10\t12\t.\t+\t0\tParent=P.1\n"
        "c1\tt\tgene\t13\t21\t.\t-\t.\tID=M\nc1\tt\tmRNA\t13\t21\t.\t-\t.\tID=M.1;Parent=M\nc1\tt\tCDS\t13\t21\t.\t-\t0\tParent=M.1\nc1\tt\texon\t13\t21\t.\t-\t.\tParent=M.1\n"
    )
    path = write(folder, "s.gff3", text)
    genome = spark.createDataFrame([("c1", "ATGAAAcccTAA" + "TTACATCAT")], "seq_id string, sequence string")
    table = features(spark, path)
    selected, _ = genomics.select_canonical(table)
    species = spark.createDataFrame([(path, "Sp", "S p", "G", None)], "file string, species_id string, species_name string, group string, species_subfamily string")
    found = by(genomics.canonical_map(table, selected, genome, species), "stable_id")
    assert (found["Sp__P"]["cds_length"], found["Sp__P"]["protein_length"], found["Sp__P"]["cds_modulo_3"]) == (9, 2, 0)
    assert (found["Sp__M"]["strand"], found["Sp__M"]["protein_length"], found["Sp__M"]["transcript_length"]) == ("-", 2, 9)
    segments = table.where("feature = 'CDS'").withColumnRenamed("parent", "transcript_id")
    proteins = by(tiles.spliced_from_tiles(segments, tiles.tile_sequences(genome.withColumnRenamed("seq_id", "seqid"), ["seqid"], width=4), ["seqid"], width=4), "transcript_id")
    assert (proteins["P.1"]["cds"], proteins["P.1"]["protein"]) == ("ATGAAATAA", "MK*")
    assert (proteins["M.1"]["cds"], proteins["M.1"]["protein"]) == ("ATGATGTAA", "MM*")


def test_search_tables_and_members(spark, folder):
    def domain(target, full, ievalue, start=2, end=3):
        f = [target, "-", "9", "PF1", "-", "50", full, "30", "0", "1", "1", "1e-9", ievalue, "25.5", "0", "1", "9", str(start), str(end), "1", "9", "0.9", "some words here"]
        return "  ".join(f)

    lines = ["# head", domain("Sp__a", "1e-20", "1e-8"), domain("Sp__a", "1e-20", "1e-9", 1, 99), domain("Sp__b", "1", "1e-9"), "short line", domain("Sp__a", "1e-20", "1e-9", 3, 4)]
    domains = hits.read_domain_hits(spark, write(folder, "d.txt", "\n".join(lines)))
    assert domains.count() == 4
    blast = "# c\nq1\tSp__a\t50\t80\t0\t0\t1\t80\t1\t80\t1e-10\t90\t100\t120\nq2\tSp__a\t50\t80\t0\t0\t1\t80\t1\t80\t1e-10\t95\t100\t120\nq1\tSp__c\t50\t80\t0\t0\t1\t80\t1\t80\t1e-10\t90\t100\t120\n"
    aligned = hits.read_alignment_hits(spark, write(folder, "b.txt", blast))
    assert {r.query_coverage for r in aligned.collect()} == {80.0}
    canonical = spark.createDataFrame([(f"Sp__{x}", "Sp", x, "G") for x in "abc"], "stable_id string, species_id string, gene_id string, group string")
    proteins = spark.createDataFrame([("Sp__a", "MKXV*"), ("Sp__c", "MMM")], "seq_id string, sequence string")
    subfamilies = spark.createDataFrame([("Sp__a", "old", 1), ("Sp__a", "S1", 2)], "stable_id string, subfamily string, ordinal int")
    notes = spark.createDataFrame([("Sp__a", "yes", "x")], "stable_id string, call string, localization_site string")
    tables = genomics.family_members(domains, aligned, canonical, proteins, "intersection", subfamilies=subfamilies, annotations={"localization": notes}, species_ids=["Sp"])
    member = tables["members"].collect()[0]
    assert (member.stable_id, member.subfamily, member.hmm_ali_to, member.blast_query_id) == ("Sp__a", "S1", 99, "q2")
    assert (member.localization_call, member.localization_site, member.protein_property_qc) == ("yes", "x", "NON_STANDARD_RESIDUES_REMOVED")
    assert rows(tables["rejected"], "stable_id", "rejection_reason") == {("Sp__c", "missing_hmm_evidence")}
    assert rows(tables["domains"]) == {("Sp__a", "MKXV*")}
    assert rows(tables["distribution"], "subfamily", "gene_count") == {("S1", 1)}
    listed = spark.createDataFrame([("Sp__c",)], "stable_id string")
    given = genomics.family_members(domains, aligned, canonical, proteins, listed=listed, properties=False)
    assert rows(given["members"], "stable_id", "selection_basis") == {("Sp__c", "precomputed")}
    with pytest.raises(ValueError, match="CANDIDATE_HAS_PROTEIN"):
        genomics.family_members(domains, aligned, canonical, proteins.where("seq_id = 'none'"))


def test_protein_properties(spark):
    df = spark.createDataFrame([("MKWVTFISLLFLFSSAYS*",), ("acd",), ("XX*",), ("AXC",)], "sequence string")
    found = by(sequences.with_protein_properties(df), "sequence")
    assert found["acd"]["molecular_weight_da"] == pytest.approx(89.0932 + 121.1582 + 133.1027 - 2 * 18.0153)
    # A in front (7.59), D at the end (4.55) and its side chain (4.05): the negative halves sum to one at pH 4.3
    assert found["acd"]["theoretical_pi"] == pytest.approx(4.30, abs=0.01)
    assert 8.0 < found["MKWVTFISLLFLFSSAYS*"]["theoretical_pi"] < 9.0
    assert found["XX*"]["protein_property_qc"] == "NO_STANDARD_RESIDUES" and found["XX*"]["theoretical_pi"] is None
    assert found["AXC"]["protein_property_qc"] == "NON_STANDARD_RESIDUES_REMOVED"


def test_sequence_expressions(spark):
    df = spark.createDataFrame([("ACGTRYKMn",)], "s string")
    assert df.select(sequences.reverse_complement("s")).collect()[0][0] == "nKMRYACGT"
    cut = df.select(*[sequences.closed_substring("s", a, b) for a, b in ((spark_lit(-3), spark_lit(2)), (spark_lit(8), spark_lit(99)), (spark_lit(10), spark_lit(12)))]).collect()[0]
    assert tuple(cut) == ("AC", "Mn", None)
    assert spark.createDataFrame([("atgNNNTAAgg",)], "s string").select(sequences.translate_codons("s")).collect()[0][0] == "MX*"


def spark_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_duplication_sources(spark, folder):
    write(folder, "out/SpA.wgd.pairs", "Duplicate 1\tLocation\tDuplicate 2\nSpA__a\tx\tSpA__b\ty\t1\nshort\n")
    write(folder, "out/SpA.tandem.pairs", "SpA__c\tx\tSpA__d\n")
    write(folder, "out/SpA.singletons", "GeneID\tx\nSpA__e\t1\n")
    pairs = hits.read_duplication_pairs(spark, folder)
    assert rows(pairs, "species_id", "stable_id_1", "stable_id_2", "duplication_mode") == {("SpA", "SpA__a", "SpA__b", "WGD"), ("SpA", "SpA__c", "SpA__d", "Tandem")}
    assigned = hits.duplication_assignments(pairs, hits.read_singletons(spark, folder))
    members = spark.createDataFrame([("SpA", x, f"SpA__{x}") for x in "abez"], "species_id string, gene_id string, stable_id string")
    modes = by(genomics.duplication_modes(members, assigned, pairs), "stable_id")
    assert {k: v["duplication_mode"] for k, v in modes.items()} == {"SpA__a": "WGD", "SpA__b": "WGD", "SpA__e": "Singleton", "SpA__z": "Unclassified"}
    assert modes["SpA__a"]["partner_stable_ids"] == "SpA__b" and modes["SpA__z"]["partner_stable_ids"] is None


def test_imported_duplication_and_ids(spark):
    table = spark.createDataFrame([("SpA", "a", "WGD", "b; SpB__x,b"), ("SpA", "q", "WGD", "NA"), ("SpA", "c", "Tandem", None)], "Species string, gene_id string, Type string, partner string")
    members = spark.createDataFrame([("SpA__a",), ("SpA__c",)], "stable_id string")
    modes, pairs = delimited.duplication_table(table, members)
    assert rows(modes) == {("SpA__a", "WGD", "SpA__b;SpB__x"), ("SpA__c", "Tandem", None)}
    assert sorted(r.stable_id_2 for r in pairs.collect()) == ["SpA__b", "SpA__b", "SpB__x"]
    assert rows(delimited.member_list(table)) == {("SpA__a",), ("SpA__q",), ("SpA__c",)}


def test_motif_sources(spark, folder):
    path = write(folder, "fimo.tsv", "motif_id\tsequence_name\tstart\tp-value\nM1\tA1\t5\t1e-4\n\n# end\n")
    row = hits.read_motif_hits(spark, path).collect()[0]
    assert (row.stable_id, row.element, row.sequence_start, row.p_value, row.q_value) == ("A1", "M1", 5, 1e-4, None)
    coordinates = spark.createDataFrame([("Sp__g", "g"), ("Sp__h", "h"), ("Sq__h", "h")], "stable_id string, gene_id string")
    table = spark.createDataFrame([("g", "E"), ("h", "E")], "gene string, cis_element string")
    assert rows(hits.imported_motif_hits(table, coordinates), "stable_id", "element") == {("Sp__g", "E"), (None, "E")}


def test_estimates_and_completeness(spark, folder):
    table = spark.createDataFrame([("p1", "0.1", "0.2", "0.5"), ("p2", "0.1", "0", None), ("p3", "x", "1", None)], "`pair_id` string, `Ka` string, `Ks` string, `Ka/Ks` string")
    found = by(delimited.substitution_estimates(table), "pair_id")
    assert found["p1"]["Ka_Ks"] == 0.5 and found["p2"]["Ka_Ks"] == float("inf") and found["p3"]["Ka"] is None
    good = write(folder, "short_summary.a.txt", "# BUSCO\n\tC:98.5%[S:97.0%,D:1.5%], F:0.5%, M:1.0%, n:1614\n")
    bad = write(folder, "short_summary.b.txt", "nothing")
    got = by(hits.read_completeness(spark, {"A": good, "B": bad}, "x_odb10"), "species_id")
    assert (got["A"]["complete_pct"], got["A"]["busco_n"], got["B"]["complete_pct"]) == (98.5, 1614, None)


def test_sinks(spark, folder):
    import hashlib

    df = spark.createDataFrame([("a", None, 1.5)], "x string, y string, z double").coalesce(1)
    sinks.write_tsv(df, folder + "/t")
    part = next(n for n in os.listdir(folder + "/t") if n.startswith("part"))
    assert open(f"{folder}/t/{part}").read() == "x\ty\tz\na\tNA\t1.5\n"
    sinks.write_json(df, folder + "/j")
    path = write(folder, "m/sub/file.TXT", "abc")
    write(folder, "m/none", "")
    found = by(sinks.result_manifest(spark, folder + "/m"), "relative_path")
    assert found["sub/file.TXT"] == {"relative_path": "sub/file.TXT", "size_bytes": 3, "sha256": hashlib.sha256(open(path, "rb").read()).hexdigest(), "suffix": ".txt"}
    assert found["none"]["size_bytes"] == 0 and found["none"]["suffix"] == ""


def test_maps_reviews_and_study_tables(spark, folder):
    maps = [write(folder, f"{s}.tsv", f"stable_id\tgene_start\n{s}__a\t5\n{s}__b\tNA\n") for s in ("A", "B")]
    ids = spark.createDataFrame([("A__a",), ("B__b",)], "stable_id string")
    assert rows(delimited.canonical_maps(spark, maps, ids)) == {("A__a", 5), ("B__b", None)}
    review = delimited.read_review_table(spark, write(folder, "truth.tsv", "\ufeffspecies_id\tgene_id\n A \tx\nB\t\n"))
    assert rows(review, "row_number", "species_id", "gene_id") == {(2, "A", "x"), (3, "B", None)}
    species, samples = genomics.study_tables(spark, [("A", "n", "G", None, True, None)], [("s", "A", "c", "t")])
    assert species.count() == samples.count() == 1
    with pytest.raises(ValueError, match="OUTGROUP_KNOWN"):
        genomics.study_tables(spark, [("A", "n", "G", None, True, "Z")])


def test_checked_join(spark):
    from cladegrid.operators.joins import checked_left_join

    left = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([("a", "p")], "k string, y string")
    joined, violations = checked_left_join(left, right, ["k"])
    assert joined.count() == 2 and violations.count() == 0
    assert rows(checked_left_join(left, right, ["k"], one_to_one=True)[1], "rule") == {("LEFT_KEY_UNIQUE",)}


def test_ordinals_follow_files_and_lines(spark, folder):
    """Files of very different size in many blocks, whose tasks are not in file order."""
    row = "q{}\t{}\t50\t80\t0\t0\t1\t80\t1\t80\t1e-10\t90\t100\t120"
    paths = [write(folder, f"{name}.txt", "\n".join(row.format(f"{name}{i}", f"s{i % 3}") for i in range(n))) for name, n in (("c", 3), ("a b", 400), ("b", 40))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        hit = hits.read_alignment_hits(spark, paths)
        assert hit.select("ordinal.file", "ordinal.block").distinct().count() > 20
        expected = [f"q{name}{i}" for name, n in (("c", 3), ("a b", 400), ("b", 40)) for i in range(n)]
        assert [r.query_id for r in hit.orderBy("ordinal").select("query_id").collect()] == expected
        best = evidence.best_alignment_hit(hits.read_alignment_hits(spark, paths[::-1]))
        assert rows(best, "query_id") == {("qb0",), ("qb1",), ("qb2",)}
        below = hits.read_alignment_hits(spark, [folder])  # a folder: by name
        assert below.orderBy("ordinal").first().query_id == "qa b0"
        one = hits.read_alignment_hits(spark, paths[1])
        assert [r.query_id for r in one.orderBy("ordinal").collect()] == expected[3:403]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pairs_arrive_by_file_and_line(spark, folder):
    for name, n in (("SpA.wgd", 200), ("SpB.tandem", 2), ("SpC.wgd", 60)):
        lines = [f"{name[:3]}__{i}\tx\t{name[:3]}__{i + 1}" for i in reversed(range(n))]
        write(folder, f"{name}.pairs", "\n".join(lines))
    write(folder, "SpD.proximal.pairs", "SpA__1\tx\tSpA__0\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        listed = hits.read_duplication_pairs(spark, folder)
        members = listed.selectExpr("explode(array(stable_id_1, stable_id_2)) AS stable_id").distinct()
        found = genomics.substitution_pairs(members, None, listed, "SpA", max_per_group=2)
        got = rows(found.where("pair_type not like '%;%'"), "stable_id_1", "stable_id_2")
        assert got == {("SpA__199", "SpA__200"), ("SpA__198", "SpA__199"), ("SpB__1", "SpB__2"), ("SpB__0", "SpB__1"), ("SpC__59", "SpC__60"), ("SpC__58", "SpC__59")}
        both = found.where("pair_type like '%;%'").collect()
        assert [(r.pair_type, r.group_id) for r in both] == [("duplication_WGD;duplication_Proximal", "SpA;SpD")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
