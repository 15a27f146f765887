import gzip
import hashlib
import os
import random

import pytest
from conftest import by, rows

from cladegrid.functions.sequences import reverse_complement
from cladegrid.operators import tiles
from cladegrid.sources import ranges, sinks


def write_file(folder, name, data):
    path = os.path.join(folder, name)
    with (gzip.open if name.endswith(".gz") else open)(path, "wb") as f:
        f.write(data)
    return path


def fasta(rng, n):
    """Sequences, and their file with headers of all lengths, blank lines, and lines of any width."""
    known, out = {}, b""
    for i in range(n):
        sequence = "".join(rng.choice("ACGTN") for _ in range(rng.choice([0, 1, 7, 64, 65, 500])))
        known[f"s{i}"] = sequence
        out += f">s{i} {'described ' * rng.randrange(6)}".encode() + rng.choice([b"\n", b"\r\n"])
        at = 0
        while at < len(sequence):
            step = rng.choice([1, 10, 60, 1000])
            out += sequence[at : at + step].encode() + rng.choice([b"\n", b"\r\n", b"\n\n"])
            at += step
    return known, out


@pytest.mark.parametrize("range_bytes,width", [(1, 8), (17, 5), (64, 64), (100000, 16)])
def test_tiles_of_any_ranges(spark, folder, range_bytes, width):
    known, data = fasta(random.Random(range_bytes), 4 if range_bytes == 1 else 25)
    if range_bytes == 1:
        known, data = {"a": "ACGTACGTAC", "b": "TT"}, b">a long name\nACGT\r\nACGTAC\n>b\nTT"
    paths = [write_file(folder, "x.fa", data), write_file(folder, "y.fa.gz", data.rstrip(b"\n"))]
    found = tiles.read_tiles(spark, paths, width, range_bytes).collect()
    for path in paths:
        own = sorted((r.seq_id, r.tile, r.residues) for r in found if r.file == path)
        expected = sorted((s, k, q[k * width : (k + 1) * width]) for s, q in known.items() for k in range(-(-len(q) // width)))
        assert own == expected


def test_headers_are_read_once_whatever_the_range():
    data = b"skipped\n>one x\nAC\n>\nGT\n>two"
    for step in range(1, len(data) + 1):
        path = write_file("/tmp", f"headers-{os.getpid()}.fa", data)
        seen = []
        for k, a in enumerate(range(0, len(data), step)):
            part = ranges.FileRange(path, k, a, min(a + step, len(data)), len(data))
            seen += [p[1] for p in ranges.pieces_of_range(part, 4) if p[1] is not None and p[2] == 0 and p[3] == ""]
        assert seen == ["one", "", "two"]


def test_cut_and_splice(spark):
    rng = random.Random(2)
    sequence = "".join(rng.choice("ACGT") for _ in range(1000))
    whole = spark.createDataFrame([("c1", sequence), ("c2", "ACGT"), ("c3", "")], "seqid string, sequence string")
    cut = tiles.tile_sequences(whole, ["seqid"], width=32)
    assert max(len(r.residues) for r in cut.collect()) == 32
    assert rows(tiles.tile_lengths(cut, ["seqid"], 32)) == {("c1", 1000), ("c2", 4), ("c3", 0)}
    wanted = [("c1", i, a, a + rng.randrange(-3, 200)) for i, a in enumerate(rng.randrange(-50, 1100) for _ in range(80))] + [("c2", 900, 2, 9), ("c9", 901, 1, 2), ("c2", 902, 2, None)]
    found = by(tiles.cut_intervals(spark.createDataFrame(wanted, "seqid string, id long, start long, end long"), cut, ["seqid"], width=32), "id")
    for seqid, i, a, b in wanted:
        text = {"c1": sequence, "c2": "ACGT"}.get(seqid, "")
        assert found[i]["piece"] == ((text[max(a, 1) - 1 : b] or None) if b is not None and b >= max(a, 1) else None), (a, b)
    twice = spark.createDataFrame([("c2", 1, 2)] * 2, "seqid string, start long, end long")
    assert [r.piece for r in tiles.cut_intervals(twice, cut, ["seqid"], width=32).collect()] == ["AC", "AC"]
    segments = [("t", "c1", "-", 100, 160), ("t", "c1", "-", 20, 40), ("u", "c1", "+", 1, 9)]
    spliced = by(tiles.spliced_from_tiles(spark.createDataFrame(segments, "transcript_id string, seqid string, strand string, start long, end long"), cut, ["seqid"], width=32), "transcript_id")
    plus = spark.createDataFrame([(sequence[19:40] + sequence[99:160],)], "s string").select(reverse_complement("s").alias("r")).first().r
    assert spliced["t"]["cds"] == plus and spliced["u"]["cds"] == sequence[:9] and len(spliced["u"]["protein"]) == 3


def test_facts_of_files(spark, folder):
    contents = {"a.txt": b"\n# note\n>one\nAC\n>two", "empty": b"", "b.gff.gz": b"##gff\n" + b"c1\tx\n" * 300_000}
    for name, data in contents.items():
        write_file(folder, name, data)
    found = {os.path.basename(r.path): r for r in sinks.file_facts(spark, folder).collect()}
    assert (found["a.txt"].n_lines, found["a.txt"].n_records, found["a.txt"].n_content_lines, found["a.txt"].first_line) == (5, 2, 3, ">one")
    assert (found["b.gff.gz"].n_lines, found["b.gff.gz"].n_content_lines, found["b.gff.gz"].first_line) == (300_001, 300_000, "c1\tx")
    for name in contents:
        raw = open(os.path.join(folder, name), "rb").read()
        assert (found[name].size_bytes, found[name].sha256) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert found["empty"].first_line is None and found["empty"].n_lines == 0
    with pytest.raises(Exception, match="none"):
        sinks.file_facts(spark, os.path.join(folder, "none")).collect()


def test_digest_of_a_file_of_three_gigabytes(spark, folder):
    path = os.path.join(folder, "sparse")
    with open(path, "wb") as f:
        f.truncate(3 << 30)
    expected = hashlib.sha256()
    for _ in range(3 << 6):
        expected.update(bytes(16 << 20))
    found = sinks.file_facts(spark, path).first()
    assert (found.size_bytes, found.sha256, found.n_lines) == (3 << 30, expected.hexdigest(), 1)
