import pytest
from conftest import by, rows

from cladegrid.operators import distribution
from cladegrid.operators.expect import QualityError
from cladegrid.plans import genomics

SPECIES = ["SpA", "SpB"]


@pytest.fixture()
def study(spark):
    members = spark.createDataFrame(
        [("A1", "SpA", "A1", "S1", "Cultivated"), ("A2", "SpA", "A2", "S2", "Cultivated"), ("B1", "SpB", "B1", "S1", "Wild"), ("B2", "SpB", "B2", "S2", "Wild")],
        "stable_id string, species_id string, gene_id string, subfamily string, group string",
    )
    membership = spark.createDataFrame(
        [("H1", "A1", "SpA"), ("H1", "B1", "SpB"), ("H2", "A2", "SpA"), ("H3", "B2", "SpB")], "HOG_ID string, stable_id string, species_id string"
    )
    classes = spark.createDataFrame([("H1", "Core"), ("H2", "Shell"), ("H3", "Shell")], "HOG_ID string, pan_family_class string")
    return members, membership, classes


def test_zero_complete_family_distribution(spark):
    members = spark.createDataFrame([("A1", "SpA", "S1"), ("A2", "SpA", None), ("B1", "SpB", " s2 ")], "stable_id string, species_id string, subfamily string")
    found = by(genomics.family_distribution(members, ["SpA", "SpB", "SpC"]), "species_id", "subfamily")
    assert len(found) == 9
    assert found[("SpA", "Unassigned")]["gene_count"] == 1 and found[("SpA", "S1")]["within_species_fraction"] == 0.5
    assert found[("SpC", "S1")]["gene_count"] == 0 and found[("SpC", "S1")]["within_species_fraction"] is None
    assert found[("SpB", "s2")]["absence_interpretation"] == "ANNOTATION_COUNT_NOT_VALIDATED_GENE_LOSS"


def test_two_denominators(study):
    members, membership, classes = study
    tables = genomics.pan_summaries(classes, membership, members, SPECIES)
    summary = by(tables["class_summary"], "counting_unit", "pan_family_class")
    assert summary[("HOG", "Core")]["fraction"] == pytest.approx(1 / 3)
    assert summary[("GENE", "Core")]["fraction"] == 0.5
    assert summary[("GENE", "Cloud")]["count"] == 0 and len(summary) == 8
    assert tables["species_class_summary"].count() == 8 and tables["subfamily_class_summary"].count() == 8


def test_species_conflict_is_refused(study, spark):
    members, _, classes = study
    wrong = spark.createDataFrame([("H1", "A1", "SpB")], "HOG_ID string, stable_id string, species_id string")
    with pytest.raises(QualityError, match="SPECIES_CONSISTENT"):
        genomics.pan_summaries(classes, wrong, members, SPECIES)


def test_duplication_strata(study, spark):
    members, membership, classes = study
    modes = spark.createDataFrame(
        [("A1", "SpA", "WGD"), ("A2", "SpA", "Tandem"), ("B1", "SpB", "WGD"), ("B2", "SpB", None)], "stable_id string, species_id string, duplication_mode string"
    )
    found = by(genomics.duplication_summary(modes, members, membership, classes), "stratification", "stratum", "duplication_mode")
    assert found[("SPECIES", "SpA", "WGD")]["within_stratum_fraction"] == 0.5
    assert found[("PAN_CLASS", "Core", "WGD")]["gene_count"] == 2 and found[("PAN_CLASS", "Core", "Tandem")]["gene_count"] == 0
    assert found[("SUBFAMILY", "S2", "Unassigned")]["gene_count"] == 1 and len(found) == 18


@pytest.fixture()
def promoters(spark):
    coordinates = spark.createDataFrame(
        [("A1", "SpA", "A1", 1000), ("A2", "SpA", "A2", 1000), ("A3", "SpA", "A3", 1000), ("B1", "SpB", "B1", 1000), ("B2", "SpB", "B2", 1000)],
        "stable_id string, species_id string, gene_id string, promoter_length long",
    )
    members = spark.createDataFrame(
        [("A1", "S1", "G1"), ("A2", "S2", "G1"), ("A3", None, "n/a"), ("B1", "S1", "G2"), ("B2", "S2", "G2")], "stable_id string, subfamily string, group string"
    )
    listed = ["A1:E1", "A1:E1", "A2:E2", "A3:E1", "B1:E1", "B2:E2", "B2:E2", "A1:E3", "A2:E3", "A3:E3", "B1:E3", "B2:E3", "B2: "]
    hits = spark.createDataFrame([tuple(h.split(":")) for h in listed], "stable_id string, element string")
    return hits, coordinates, members


def test_motif_cells(promoters):
    cells, qc = genomics.promoter_distributions(*promoters)
    found = by(cells, "aggregation_level", "cell_id", "element")
    zero = found[("SPECIES_SUBFAMILY", "species_id=SpA|subfamily=S1", "E2")]
    assert (zero["motif_hit_count"], zero["genes_with_hit"], zero["n_genes"], zero["total_promoter_bp"], zero["hits_per_kb"]) == (0, 0, 1, 1000, 0.0)
    species = found[("SPECIES", "species_id=SpA", "E1")]
    assert (species["motif_hit_count"], species["n_genes"], species["hits_per_kb"], species["group"]) == (3, 3, 1.0, "NOT_APPLICABLE")
    assert found[("GROUP_SUBFAMILY", "group=G1|subfamily=S1", "E2")]["motif_hit_count"] == 0
    quality = by(qc, "aggregation_level")
    excluded = [quality[n]["excluded_genes_missing_annotation"] for n in ("SPECIES", "SUBFAMILY", "GROUP", "SPECIES_SUBFAMILY", "GROUP_SUBFAMILY")]
    assert excluded == [0, 1, 1, 1, 1]
    assert quality["SPECIES"]["complete_grid_rows"] == 6 and quality["SPECIES"]["qc_status"] == "PASS"


def test_zscore_states(spark):
    coordinates = spark.createDataFrame([("A1", "SpA", "A1", 1000), ("B1", "SpB", "B1", 2000)], "stable_id string, species_id string, gene_id string, promoter_length long")
    members = spark.createDataFrame([("A1", "S1", "Only"), ("B1", "S1", "Only")], "stable_id string, subfamily string, group string")
    hits = spark.createDataFrame([("A1", "E1"), ("A1", "E1"), ("B1", "E1"), ("A1", "E2"), ("B1", "E2")], "stable_id string, element string")
    cells, _ = genomics.promoter_distributions(hits, coordinates, members)
    found = by(cells, "aggregation_level", "cell_id", "element")
    a, b = (found[("SPECIES", f"species_id={s}", "E1")] for s in SPECIES)
    assert (a["zscore_motif_hit_count"], b["zscore_motif_hit_count"]) == pytest.approx((1.0, -1.0))
    assert (a["zscore_hits_per_kb"], b["zscore_hits_per_kb"]) == pytest.approx((1.0, -1.0))
    flat = found[("SPECIES", "species_id=SpA", "E2")]
    assert (flat["raw_zscore_status"], flat["zscore_motif_hit_count"], flat["rate_zscore_status"]) == ("ZERO_VARIANCE", 0.0, "PASS")
    lone = found[("GROUP", "group=Only", "E1")]
    assert (lone["raw_zscore_status"], lone["zscore_motif_hit_count"]) == ("INSUFFICIENT_CELLS", None)


def test_zero_length_and_no_elements(spark):
    coordinates = spark.createDataFrame([("A1", "SpA", "A1", 0), ("B1", "SpB", "B1", 500)], "stable_id string, species_id string, gene_id string, promoter_length long")
    members = spark.createDataFrame([("A1", None), ("B1", None)], "stable_id string, subfamily string")
    hits = spark.createDataFrame([("A1", "E1")], "stable_id string, element string")
    cells, qc = genomics.promoter_distributions(hits, coordinates, members)
    found = by(cells, "aggregation_level", "cell_id")
    assert found[("SPECIES", "species_id=SpA")]["hits_per_kb"] is None
    assert found[("SPECIES", "species_id=SpA")]["rate_zscore_status"] == "MISSING_DENOMINATOR"
    quality = by(qc, "aggregation_level")
    assert quality["SPECIES"]["qc_status"] == "ZERO_PROMOTER_LENGTH" and quality["SUBFAMILY"]["qc_status"] == "NO_ELIGIBLE_GENES"
    _, qc = genomics.promoter_distributions(hits.where("element = 'none'"), coordinates, members)
    assert by(qc, "aggregation_level")["SPECIES"]["qc_status"] == "NO_ELEMENTS"


def test_promoter_rules(promoters, spark):
    hits, coordinates, members = promoters
    with pytest.raises(QualityError, match="HIT_HAS_PROMOTER"):
        genomics.promoter_distributions(spark.createDataFrame([("Z9", "E1")], hits.schema), coordinates, members)
    broken = coordinates.selectExpr("stable_id", "species_id", "gene_id", "nullif(promoter_length, 1000) AS promoter_length")
    with pytest.raises(QualityError, match="PROMOTER_LENGTH"):
        genomics.promoter_distributions(hits, broken, members)


def test_profile_classes_and_charts(promoters, spark):
    hits, coordinates, members = promoters
    categories = spark.createDataFrame([("E1", "light"), ("E2", None)], "element string, major_class string")
    tables = genomics.promoter_profile(hits.where("trim(element) <> ''"), coordinates, members, categories, top_n=2)
    assert rows(tables["class_counts"]) == {("light", 4), ("Unclassified", 8)}
    assert [r.element for r in tables["top_elements"].collect()] == ["E3", "E1"]
    assert by(tables["elements"], "element")["E2"]["subclass"] == "E2"
    assert by(tables["per_gene"], "stable_id", "major_class")[("A1", "light")]["element_count"] == 2


def test_matrix_and_slices(spark):
    df = spark.createDataFrame([("r1", "a", 1), ("r1", "b", 0), ("r2", "a", 3)], "i string, c string, v long")
    assert rows(distribution.ordered_matrix(df, "i", "c", "v", ["b", "a"], 0.0)) == {("r1", 0.0, 1.0), ("r2", 0.0, 3.0)}
    assert by(distribution.ordered_matrix(df, "i", "c", "v", ["b", "a"]), "i")["r2"]["b"] is None
    assert rows(distribution.positive_slices(df, "c", "v")) == {("a", 1), ("a", 3)}
