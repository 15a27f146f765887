"""Group tables of an orthology run: which file to read and what that says about the groups."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cladegrid.functions.scalars import resolve_column

NODE_FOLDER = "Phylogenetic_Hierarchical_Orthogroups"
FALLBACK = "Orthogroups/Orthogroups.tsv"


@dataclass(frozen=True)
class GroupSource:
    path: str
    node: str
    node_status: str
    group_type: str
    analysis_unit: str
    relative_path: str


def _list(spark: SparkSession, folder: str) -> list[str]:
    """File names of a folder through the cluster's file system; empty when it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isFile()] if fs.exists(path) else []


def select_group_table(spark: SparkSession, directory: str, node: str = "auto") -> GroupSource:
    """``auto``: the root node table, else the lowest numbered one, else the flat group table."""
    base = directory.rstrip("/")
    nodes = _list(spark, f"{base}/{NODE_FOLDER}")
    if node.lower() == "auto":
        numbered = sorted((int(m[1]), n) for n in nodes if (m := re.fullmatch(r"N(\d+)\.tsv", n)))
        if numbered:
            name, status, kind = numbered[0][1], "AUTO_DISCOVERY", "HOG"
        elif "Orthogroups.tsv" in _list(spark, f"{base}/Orthogroups"):
            return GroupSource(
                f"{base}/{FALLBACK}", "Orthogroups", "AUTO_ORTHOGROUP_FALLBACK", "ORTHOGROUP", "ORTHOFINDER_ORTHOGROUP", FALLBACK
            )
        else:
            raise FileNotFoundError(f"no group table below {base}")
    else:
        name, status, kind = (node if node.endswith(".tsv") else f"{node}.tsv"), "CONFIGURED", "HOG"
        if name not in nodes:
            raise FileNotFoundError(f"configured node table does not exist: {base}/{NODE_FOLDER}/{name}")
    relative = f"{NODE_FOLDER}/{name}"
    return GroupSource(f"{base}/{relative}", name.removesuffix(".tsv"), status, kind, "ORTHOFINDER_HOG", relative)


def read_group_table(spark: SparkSession, source: GroupSource) -> tuple[DataFrame, str]:
    """(wide table, all text; name of its group column)."""
    wide = spark.read.options(header="true", sep="\t").csv(source.path)
    return wide, resolve_column(wide.columns, ("hog", "hog_id", "orthogroup", wide.columns[0]))


def provenance(source: GroupSource) -> dict[str, str]:
    """Constant columns that say what a class does and does not mean."""
    return {
        "hog_node": source.node,
        "hog_node_status": source.node_status,
        "orthology_group_type": source.group_type,
        "orthology_source_file": source.relative_path,
        "analysis_scope": "TARGET_GENE_FAMILY_ONLY",
        "analysis_unit": source.analysis_unit,
        "presence_basis": f"ANNOTATION_AND_{source.group_type}_MEMBERSHIP",
        "absence_validation_status": "NOT_GENOME_RESCUED",
        "interpretation_flag": "ANNOTATION_OCCUPANCY_NOT_VALIDATED_GENE_LOSS",
    }
