"""Files read and written in temporary folders."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from simquarry.operators.bundles import latest_outcomes
from simquarry.operators.retention import dir_sizes
from simquarry.operators.structure import chain_sequences
from simquarry.operators.trajectory import gate
from simquarry.sources import documents, files, sinks, tables


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def atom(serial, name, resname, chain, resnum, record="ATOM", x="1.000", element="C"):
    return f"{record:<6}{serial:>5} {name:<4} {resname:<3} {chain}{resnum:>4}    {x:>8}{2.5:>8}{-3.25:>8}  1.00  0.00          {element:>2}"


@pytest.fixture
def small_splits(spark):
    """Cut files into many blocks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_are_numbered_across_blocks(spark, tmp_path, small_splits):
    for name, n in (("a.txt", 3000), ("b.txt", 17), ("c.txt", 1)):
        (tmp_path / name).write_text("".join(f"{name}-{k}\n" for k in range(1, n + 1)))
    df = files.read_lines(spark, str(tmp_path))
    assert df.select("block").distinct().count() > 3
    got = {(os.path.basename(r["path"]), r["line_no"]): r["line"] for r in df.collect()}
    assert len(got) == 3018 and all(line == f"{name}-{no}" for (name, no), line in got.items())


def test_pdb(spark, tmp_path, small_splits):
    lines = ["HEADER x", "MODEL        1", atom(1, "N", "ALA", "A", 1), atom(2, "CA", "ALA", "A", 1, x="bad"), atom(3, "C1", "LIG", "B", "x", "HETATM", element="??"), "ENDMDL", "MODEL        2"]
    lines += [atom(k, "CA", "GLY", "A", k) for k in range(4, 300)] + ["ATOM  short"]
    (tmp_path / "s.pdb").write_text("\n".join(lines))
    df = files.read_pdb_atoms(spark, str(tmp_path)).orderBy("line_no")
    got = df.collect()
    assert len(got) == 300
    assert got[0].asDict() == {
        "path": got[0]["path"], "line_no": 3, "record": "ATOM", "serial": 1, "name": "N", "resname": "ALA", "chain": "A", "resnum": 1, "icode": "",
        "x": 1.0, "y": 2.5, "z": -3.25, "element": "C", "model": 1,
    }
    assert (got[1]["x"], got[1]["y"]) == (None, 2.5) and (got[2]["resnum"], got[2]["record"], got[2]["element"]) == (None, "HETATM", "??")
    assert {r["model"] for r in got[3:]} == {2} and got[-1]["x"] is None
    seq = chain_sequences(files.residue_key(df)).collect()
    assert [(r["chain"], r["number"], r["sequence"]) for r in seq] == [("A", 1, "A" + "G" * 296)]


def test_fasta(spark, make, tmp_path):
    seqs = make("sim_id string, chain string, number int, sequence string, error string", ("s1", "B", 2, "GG", None), ("s1", "A", 1, "AA", None), ("s2", None, None, None, "no sequence"))
    sinks.write_fasta(seqs, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("sim_id=s1/*.txt"))
    assert text == ">1\nAA\n>2\nGG\n" and not (tmp_path / "out" / "sim_id=s2").exists()


def test_manifests(spark, tmp_path):
    for name, body in {
        "L1": json.dumps({"files": [{"irods_path": "a", "md5_hash": "1"}, {"irods_path": "a", "md5_hash": "2"}, {"irods_path": "b", "md5_hash": None}]}, indent=2),
        "L2": '{"files": [', "L3": "", "L4": '{"other": 1}', "L5": '{"files": []}',
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "done.json").write_text(body)
    good, bad = documents.read_manifests(spark, str(tmp_path))
    last = F.substring_index("collection", "/", -1)
    assert rows(good, last, "name", "md5") == [("L1", "a", "2"), ("L1", "b", None)]
    assert rows(bad, last) == [("L2",), ("L3",), ("L4",)]


def test_imports(spark, tmp_path):
    doc = {"simulation": {
        "lead_contributor_orcid": "o", "software_name": "amber", "unique_file_hash_string": "h", "rmsd_values": [1, 2.5], "pdb": {"pdb_id": "1ABC", "title": "t", "classification": "c"},
        "processed_files": [{"name": "x", "file_type": "T", "size": 5, "md5_sum": "m"}], "replicates": ["r1", "r2"], "contributors": [{"name": "n"}],
    }}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=4))
    (tmp_path / "b.json").write_text("{")
    good, bad = documents.read_imports(spark, str(tmp_path))
    row = good.first()
    assert (row["hash"], row["alias"], row["rmsd_values"], row["software_version"]) == ("h", None, [1.0, 2.5], None)
    assert bad.count() == 1
    with_id = good.withColumn("sim_id", F.lit(7).cast("long"))
    assert rows(documents.elements(with_id, "processed_files"), "pos", "simulation_id", "name", "size", "is_primary") == [(0, 7, "x", 5, None)]
    assert rows(documents.elements(with_id, "replicates"), "pos", "e") == [(0, "r1"), (1, "r2")]
    assert rows(documents.elements(with_id, "pdb", single=True), "pdb_id", "title") == [("1ABC", "t")]
    assert documents.elements(with_id, "ligands").count() == 0


def test_outcome_log(spark, make, tmp_path):
    path = str(tmp_path / "log")
    os.mkdir(path)
    with open(f"{path}/first.txt", "w") as fh:
        fh.write("timestamp\tresult\tbundle\tdetail\n2024-01-01T00:00:00Z\tfailed\ta\tx\n2024-01-01T00:00:00Z\tdone\ta\n\nshort\tline\n")
    more = make("timestamp string, result string, bundle string, detail string", ("2024-01-02T00:00:00Z", "failed", "b", " two\n lines\t" + "y" * 600))
    sinks.append_outcomes(more, path)
    log = files.read_outcome_log(spark, path)
    assert rows(latest_outcomes(log), "bundle", "result") == [("a", "done"), ("b", "failed")]
    detail = log.where("bundle = 'b'").first()["detail"]
    assert detail == ("two lines " + "y" * 600)[:500]


def test_inventory(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "empty").mkdir()
    for name, body in (("d/f.bin", b"12345"), ("d/e/zero", b""), ("top", b"1")):
        (tmp_path / name).write_bytes(body)
        os.utime(tmp_path / name, (86400 * 365, 86400 * 365))
    want = [(str(tmp_path / n), s, dt.datetime(1971, 1, 1)) for n, s in (("d/e/zero", 0), ("d/f.bin", 5), ("top", 1))]
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        assert rows(files.read_inventory(spark, root), "path", "size", "modified_at") == sorted(want, key=str)
    tree = files.read_tree(spark, str(tmp_path))
    assert rows(tree.where("is_dir"), "name", "size") == [("d", None), ("e", None), ("empty", None)]
    sizes = dir_sizes(tree.where("not is_dir"))
    assert rows(sizes, F.substring_index("dir", "/", -1), "bytes") == sorted([("e", 0), ("d", 5), (tmp_path.name, 1)], key=str)


def test_id_list(spark, tmp_path):
    (tmp_path / "ids").write_text("12\n\n  7 \nx1\n3.5\n-4\n")
    ids, rejects = files.read_id_list(spark, str(tmp_path / "ids"))
    assert rows(ids) == [(-4,), (12,), (7,)]
    assert rows(rejects, "line_no", "text") == [(4, "x1"), (5, "3.5")]


def test_run_logs(spark, tmp_path):
    (tmp_path / "r1.log").write_text("a\nb\n")
    df = files.read_run_logs(spark, str(tmp_path))
    assert rows(df, "line_no", "line") == [(1, "a"), (2, "b")]


def test_result_documents(spark, make, tmp_path):
    v = make(
        "simulation_id long, location string, src string, dest string, size long, expected_md5 string, remote_md5 string, present boolean, verified boolean",
        (1, "irods", "s", "d2", 1, "a", "a", True, True), (1, "irods", "s", "d1", 1, "a", None, True, False),
    )
    sinks.write_results(sinks.push_results(v, make("simulation_id long, error string", (1, "late"))), str(tmp_path / "out"))
    doc = json.loads("".join(p.read_text() for p in (tmp_path / "out").glob("*.json")))
    assert (doc["complete"], doc["errors"], [f["dest"] for f in doc["files"]], doc["files"][0]["remote_md5"]) == (False, ["late"], ["d1", "d2"], None)
    series = sinks.series_document(make("sim_id int, frame long, rmsd double", (1, 2, 0.2), (1, 1, 0.1)), make("sim_id int, atom_id long, rmsf double", (1, 9, 0.9)))
    assert rows(series) == [(1, [0.1, 0.2], [0.9])]
    receipt = sinks.import_receipts(make("doc string, sim_id long", ("f.json", 4)), "prod", "/d").first().asDict()
    assert receipt == {"server": "prod", "filename": "f.json", "simulation_id": 4, "data_dir": "/d"}


def test_tables(spark, make, tmp_path):
    users = tables.conform(make("id int, username string", (1, "a")), "user")
    assert users.schema == tables.SCHEMAS["user"]
    users.write.parquet(str(tmp_path / "prod" / "user"))
    assert rows(tables.read(spark, "user", root=str(tmp_path), server="prod"), "id", "username") == [(1, "a")]
    assert tables.database_name("ticket") == "md_ticket" and tables.database_name("account").startswith("socialaccount")
    with pytest.raises(ValueError):
        tables.read(spark, "user")


def test_catalog(make):
    c = make("collection string, name string, size long, md5 string, create_time string, replica_number int", ("/a", "x", 1, "m", "t", 0), ("/a", "x", 1, "m", "t", 1), ("/b", "y", 1, "m", "t", 0))
    assert rows(tables.objects(c), "name") == [("x",), ("y",)]
    assert rows(tables.objects(c, make("collection string", ("/b",))), "name") == [("y",)]


def test_gate_feeds_the_document(make):
    series = make("sim_id int, value double", (1, 0.5))
    assert gate(series, series).first()["accepted"]
