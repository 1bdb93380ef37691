from __future__ import annotations

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from sylva import tables
from sylva.sources import predictions, registry, release, sequences
from sylva.streaming.reports import ingest_reports

RECORD = """LOCUS       NC_1  40 bp    DNA
ACCESSION   NC_1
VERSION     NC_1.1
  ORGANISM  Line name
FEATURES
                     /organism="Good name"
                     /db_xref="taxon:77"
ORIGIN
        1 acgtacgtac gtacgtacgt
       21 nnnn
//
"""


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fna").write_text(">s1 first one\nACG\n\nTT\n>s2\nGG\n")
    (tmp_path / "b.fasta").write_bytes(b"\n>s1 again\r\nCCC\r\n>s3 x\r\n\r\n>s4 mutation 12A>G of > host\r\nAC\r\nGT")
    (tmp_path / "c.txt").write_text(">no\nA\n")
    got = {r.header_id: (r.name, r.seq) for r in sequences.read_fasta(spark, f"file://{tmp_path}").collect()}
    assert got == {"s1": ("first one", "ACGTT"), "s2": ("s2", "GG"), "s3": ("x", ""), "s4": ("mutation 12A>G of > host", "ACGT")}


def test_gbff(spark, tmp_path):
    second = RECORD.replace("NC_1", "NC_2").replace("VERSION     NC_2.1\n", "").replace('/organism="Good name"', "").replace("40 bp", "x bp")
    third = RECORD.replace("NC_1", "NC_3").replace('/db_xref="taxon:77"', "")
    with gzip.open(tmp_path / "x.gbff.gz", "wt") as f:
        f.write(RECORD + second + third)
    (tmp_path / "y.gbff").write_text(RECORD.replace("NC_1", "NC_9").replace("//\n", ""))
    got = {r.accession: r for r in sequences.read_gbff(spark, f"file://{tmp_path}").collect()}
    assert set(got) == {"NC_1.1", "NC_2", "NC_9.1"}
    assert (got["NC_1.1"].organism, got["NC_1.1"].length, got["NC_1.1"].host_taxid) == ("Good name", 40, "77")
    assert (got["NC_2"].organism, got["NC_2"].length, got["NC_2"].sequence) == ("Line name", 24, "ACGTACGTACGTACGTACGTNNNN")


def test_archives_and_lookup(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("ncbi_dataset/data/GCF_1/g.fna", ">h x\nac\n")
        z.writestr("README", "no")
    (tmp_path / "bad.zip").write_text("nothing")
    got = sequences.unzip_archives(spark, f"file://{tmp_path}").collect()
    assert [(r.name, r.text) for r in got] == [("GCF_1/g.fna", ">h x\nac\n")]
    t = sequences.sequence_table(spark.createDataFrame([("h", "ac"), ("n", None)], "header_id string, seq string"))
    keys = spark.createDataFrame([("h",), ("zz",), ("n",)], "header_id string")
    assert {r.header_id: r.seq for r in sequences.look_up(keys, t).collect()} == {"h": "AC", "zz": "", "n": ""}


def test_registry_document(spark, tmp_path):
    doc = {"taxons": {"9": ["A", "B"]}, "accessions": {"A": {"taxid": "9", "total_sequence_length": 5, "downloaded": True, "headers": [{"id": "h", "name": "n"}]}, "B": {}}, "capacities": {"9": {"100": 7}}, "cross_domain_negatives": ["B"]}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    t = registry.read_registry(spark, f"file://{tmp_path}/r.json")
    assert {(r.accession, r.cross_domain) for r in t["accession"].collect()} == {("A", False), ("B", True)}
    assert [(r.taxid, r.min_len, r.capacity) for r in t["capacity"].collect()] == [("9", 100, 7)]
    assert t["lineage"].count() == 0 and t["taxon_acc"].count() == 2
    acc = t["accession"]
    rec = registry.reconcile(acc, spark.createDataFrame([("other",)], "header_id string"))
    assert not rec.where("accession = 'A'").first().downloaded
    more = spark.createDataFrame([("A", "x"), ("C", "y")], "accession string, organism string")
    merged = registry.merge_new(acc, more, "accession")
    assert merged.count() == 3 and merged.where("accession = 'A'").first().organism is None


def test_config(tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"scopes": {"2": {"default_id": "9", "redirections": {"5": {"target_id": "6"}}, "virtual_id_labels": {"6": "six"}}}}))
    s = registry.scope_of(registry.read_json_config(f"{tmp_path}/m.json"), "2")
    assert (s.redirections, s.default_id, s.labels) == ({"5": "6"}, "9", {"6": "six"})
    assert registry.scope_of({}, "3").redirections == {} and registry.read_json_config("/none", optional=True) == {}


def test_release(spark):
    lines = spark.createDataFrame([("a" * 32 + "  x/plasmid.1.genomic.gbff.gz",), ("plasmid.2.genomic.gbff.gz",), ("b" * 32 + " other",), ("",)], "value string")
    assert {(r.name, r.md5) for r in release.manifest_entries(lines).collect()} == {("plasmid.1.genomic.gbff.gz", "a" * 32), ("plasmid.2.genomic.gbff.gz", None)}
    page = '<a href="plasmid.2.genomic.gbff.gz">x</a><a href="plasmid.1.genomic.gbff.gz"><a href="plasmid.2.genomic.gbff.gz"><a href="x/plasmid.3.genomic.gbff.gz">'
    assert spark.createDataFrame([(page,)], "h string").select(release.html_listing("h")).first()[0] == ["plasmid.1.genomic.gbff.gz", "plasmid.2.genomic.gbff.gz"]
    have = spark.createDataFrame([("f1", bytearray(b"x")), ("f2", bytearray(b"y"))], "name string, content binary")
    e = spark.createDataFrame([("f1", "9dd4e461268c8034f5c8564e155c67a6"), ("f2", "0" * 32), ("f3", None)], "name string, md5 string")
    assert {r.name for r in release.stale_files(have, e).collect()} == {"f2", "f3"}


def test_classification_path(spark):
    s = "struct<id: bigint, name: string>"
    df = spark.createDataFrame([("7", (7, "s"), None, None, (1, "V")), ("8", (8, "s"), (2, "g"), (3, "K"), None)], f"taxid string, species {s}, genus {s}, superkingdom {s}, acellular_root {s}")
    got = {r.taxid: [(x.taxid, x["rank"]) for x in r.path] for r in release.ranks_to_path(df, ("species", "genus", "superkingdom")).collect()}
    assert got == {"7": [("7", "species"), ("1", "superkingdom")], "8": [("8", "species"), ("2", "genus"), ("3", "superkingdom")]}


def test_reports_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = lambda a, t: json.dumps({"accession": a, "organism": {"tax_id": t, "organism_name": "o"}, "assembly_info": {"assembly_level": "Chromosome"}, "assembly_stats": {"total_sequence_length": 3}})
    (src / "1.json").write_text(line("A", 1) + "\n{broken\n" + line("B", 2) + "\n" + json.dumps({"accession": "X"}) + "\n")
    assert release.read_reports(spark, f"file://{src}").count() == 2
    args = (f"file://{src}", f"file://{tmp_path}/cat", f"file://{tmp_path}/ck")
    ingest_reports(spark, *args)
    (src / "2.json").write_text(line("B", 9) + "\n" + line("C", 3) + "\n")
    ingest_reports(spark, *args)
    ingest_reports(spark, *args)
    got = sorted((r.accession, r.taxid, r.is_reference) for r in spark.read.parquet(f"{tmp_path}/cat").collect())
    assert got == [("A", "1", True), ("B", "2", True), ("C", "3", True)]


def test_predictions_and_samples(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("read_id\tpredicted_taxid\tpredicted_rank\nr1\t5\tgenus\nr2\t\t\n")
    assert {(r.read_id, r.predicted_taxid) for r in predictions.read_predictions(spark, f"file://{tmp_path}/p.tsv").collect()} == {("r1", "5"), ("r2", None)}
    ranks = spark.createDataFrame([("5", "genus")], "taxid string, rank string")
    lines = spark.createDataFrame([(0, "C\tr1\t5"), (1, "U\tr1\t0"), (2, "C\tr2\t5"), (3, "C\tr3\t 0"), (4, "bad")], "o int, value string")
    assert {(r.read_id, r.predicted_taxid, r.predicted_rank) for r in predictions.parse_status_output(lines, ranks, "o").collect()} == {("r1", None, None), ("r2", "5", "genus"), ("r3", None, None)}
    hits = spark.createDataFrame([(0, "readID\tseqID\ttaxID\tscore"), (1, "r1\ts\t5\t10.5"), (2, "r1\ts\t6\t10.5"), (3, "r2\ts\t0\t9"), (4, "r3\ts\t5\tx")], "o int, value string")
    assert {(r.read_id, r.predicted_taxid) for r in predictions.parse_scored_output(hits, ranks, "o").collect()} == {("r1", "5"), ("r2", None)}
    s = spark.createDataFrame([("h1", "train", "AC", 0), ("h1", "val", "GG", 1), ("h2", "train", "TT", 0)], "head string, split string, seq string, class_idx int")
    path = f"file://{tmp_path}/out"
    predictions.write_samples(s, path)
    predictions.write_samples(s.where("head = 'h1' and split = 'val'").withColumn("seq", F.lit("CC")), path)
    assert [tuple(r) for r in predictions.read_split(spark, path, "h1", "val").collect()] == [("CC", 1)]
    assert predictions.read_split(spark, path, "h2", "train").count() == 1
    predictions.write_samples(s, f"file://{tmp_path}/csv", "csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").count() == 3


def test_tables_are_replaced_in_one_step(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    mk = lambda *v: spark.createDataFrame([(x,) for x in v], "accession string")
    read = lambda: sorted(r.accession for r in tables.read_table(spark, path).collect())
    assert not tables.table_exists(spark, path)
    mk("plain").write.parquet(path)  # a folder of plain files is a table as well
    assert tables.table_exists(spark, path) and read() == ["plain"]
    tables.write_table(tables.read_table(spark, path).unionByName(mk("a")), path)
    assert read() == ["a", "plain"] and not list((tmp_path / "t").glob("*.parquet"))
    with pytest.raises(Exception, match="lost"):  # dies while it writes the new version
        tables.write_table(mk("x").select(F.raise_error(F.lit("lost")).cast("string").alias("accession")), path)
    assert read() == ["a", "plain"]
    with monkeypatch.context() as m:  # dies between the version and the mark
        m.setattr(tables, "CURRENT", None)
        with pytest.raises(Exception):
            tables.write_table(mk("y"), path)
    assert read() == ["a", "plain"]
    for v in ("b", "c", "d"):
        tables.write_table(mk(v), path)
        assert read() == [v]
    assert len(list((tmp_path / "t").glob("v-*"))) == 2


def test_capacity_cache_drops_ancestors(spark):
    caps = spark.createDataFrame([("s", 100, 1), ("g", 100, 2), ("g", 50, 2), ("r", 100, 3), ("other", 100, 4)], "taxid string, min_len int, capacity bigint")
    lin = spark.createDataFrame([("s", [("s",), ("g",), ("r",)]), ("other", [("other",), ("r",)])], "taxid string, path array<struct<taxid: string>>")
    got = registry.cached_capacities(caps, spark.createDataFrame([("s",), ("s",), (None,), ("nowhere",)], "taxid string"), lin)
    assert [(r.taxid, r.capacity) for r in got.collect()] == [("other", 4)]


def test_discovery_keeps_what_is_known(spark, tmp_path):
    from sylva import cli

    cat = f"file://{tmp_path}/cat"
    for name, text in (("one", RECORD), ("two", RECORD.replace("NC_1", "NC_2").replace("Good name", "Second") + RECORD.replace("Good name", "Changed"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.gbff").write_text(text)
        cli.main(["discover", cat, "--release", f"file://{tmp_path}/{name}"])
    acc = {r.accession: r.organism for r in tables.read_table(spark, f"{cat}/accession").collect()}
    assert acc == {"NC_1.1": "Good name", "NC_2.1": "Second"}
    assert sorted(r.header_id for r in tables.read_table(spark, f"{cat}/sequence").collect()) == ["NC_1.1", "NC_2.1"]
    # a catalogue that can't be read is never taken for a new one
    for f in (tmp_path / "cat" / "accession").rglob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):
        cli.main(["discover", cat, "--release", f"file://{tmp_path}/one"])
    assert b"broken" in {f.read_bytes() for f in (tmp_path / "cat" / "accession").rglob("*.parquet")}


def test_stream_never_appends_to_a_broken_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "cat").mkdir()
    (tmp_path / "cat" / "x.parquet").write_bytes(b"broken")
    (tmp_path / "in" / "1.json").write_text(json.dumps({"accession": "A", "organism": {"tax_id": 1}}) + "\n")
    with pytest.raises(Exception):
        ingest_reports(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/cat", f"file://{tmp_path}/ck")
    assert [f.name for f in (tmp_path / "cat").glob("*.parquet")] == ["x.parquet"]
