"""Set-wise ingest against a replay that handles one row at a time."""

import datetime as dt
import random

import pytest

from simquarry.operators import ingest

NOW = dt.datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def replay(target, source, keys, update=(), fill=(), columns=()):
    """Get-or-create, row by row, on lists of dicts."""
    table = [dict(r) for r in target]
    for row in sorted(source, key=lambda r: (r["doc"], r["pos"])):
        hits = [t for t in table if all(row[k] is not None and t[k] == row[k] for k in keys)]
        if hits:
            hit = min(hits, key=lambda t: t["id"])
            hit.update({c: row[c] for c in update})
            hit.update({c: row[c] for c in fill if row[c]})
        else:
            table.append({"id": max((t["id"] for t in table), default=0) + 1, **{c: row[c] for c in columns if c != "id"}})
    return sorted((tuple(t[c] for c in columns) for t in table), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_upsert(make, seed):
    rnd = random.Random(seed)
    maybe = lambda v: None if rnd.random() < 0.2 else v
    target = [{"id": 3 * k + 1, "a": maybe(rnd.randrange(6)), "b": maybe(f"b{rnd.randrange(3)}"), "u": maybe("old"), "f": maybe("f0")} for k in range(12)]
    source = [
        {"doc": k // 4, "pos": k % 4, "a": maybe(rnd.randrange(9)), "b": maybe(f"b{rnd.randrange(3)}"), "u": maybe(f"u{k}"), "f": rnd.choice([None, "", f"f{k}"])}
        for k in range(60)
    ]
    t = make("id long, a long, b string, u string, f string", *[tuple(r.values()) for r in target])
    s = make("doc long, pos long, a long, b string, u string, f string", *[tuple(r.values()) for r in source]).repartition(5)
    done = ingest.upsert(t, s, ["a", "b"], ["u"], ["f"])
    want = replay(target, source, ["a", "b"], ["u"], ["f"], ["id", "a", "b", "u", "f"])
    assert rows(done.table, "id", "a", "b", "u", "f") == want
    # Rows with a whole key are settled: the second run does nothing.
    keyed = s.where("a is not null and b is not null")
    settled = ingest.upsert(t, keyed, ["a", "b"], ["u"], ["f"])
    again = ingest.upsert(settled.table, keyed, ["a", "b"], ["u"], ["f"])
    assert again.actions.count() == 0 and rows(again.table) == rows(settled.table)


def test_upsert_into_an_empty_table(make, spark):
    t = spark.createDataFrame([], "id long, a long")
    s = make("doc long, pos long, a long", (2, 0, 7), (1, 1, 9), (1, 0, 8), (3, 0, 9))
    assert rows(ingest.upsert(t, s, ["a"]).table) == [(1, 8), (2, 9), (3, 7)]


def test_software_without_version_is_always_new(make):
    t = make("id long, name string, version string", (1, "x", None), (2, "x", "1"))
    s = make("doc long, pos long, name string, version string", (1, 0, "x", None), (2, 0, "x", None), (3, 0, "x", "1"))
    assert rows(ingest.upsert_software(s, t).table) == [(1, "x", None), (2, "x", "1"), (3, "x", None), (4, "x", None)]


def test_solutes_are_renamed(make):
    t = make("id long, name string, concentration double, simulation_id long", (1, "Cl+", 0.1, 5))
    s = make("doc long, pos long, simulation_id long, name string, concentration_mol_liter double", (1, 0, 5, "Cl", 0.2), (1, 1, 5, "MG", 0.3))
    assert rows(ingest.upsert_solutes(s, t).table) == [(1, "Cl+", 0.2, 5), (2, "MG", 0.3, 5)]
    assert rows(ingest.upsert_solutes(s, t, rename={}).table, "name") == [("Cl",), ("Cl+",), ("MG",)]


# --- papers ----------------------------------------------------------------
FIELDS = ["title", "authors", "journal", "volume", "year"]


def replay_papers(pubs, papers):
    pubs = [dict(p) for p in pubs]
    links = []
    for p in sorted(papers, key=lambda r: (r["doc"], r["pos"])):
        if p["doi"]:
            hits = [q for q in pubs if q["doi"] == p["doi"]]
        else:
            hits = [q for q in pubs if all(p[f] is not None and q[f] == p[f] for f in FIELDS)]
        if hits:
            pk = min(q["id"] for q in hits)
        else:
            pk = max((q["id"] for q in pubs), default=0) + 1
            pubs.append({"id": pk, **{f: p[f] for f in (*FIELDS, "doi")}})
        if (pk, p["simulation_id"]) not in links:
            links.append((pk, p["simulation_id"]))
    return sorted((tuple(q[c] for c in ("id", *FIELDS, "doi")) for q in pubs), key=str), sorted(links)


@pytest.mark.parametrize("seed", range(2))
def test_papers(make, spark, seed):
    rnd = random.Random(seed)
    paper = lambda: {
        "title": f"t{rnd.randrange(3)}", "authors": "a", "journal": rnd.choice(["j", None]), "volume": rnd.choice(["1", "2"]), "year": 2020,
        "doi": rnd.choice(["", None, "d1", "d2", "d3"]),
    }
    pubs = [{"id": k + 1, **paper()} for k in range(3)]
    papers = [{"doc": k // 3, "pos": k % 3, "simulation_id": rnd.randrange(3), **paper()} for k in range(30)]
    p_type = "title string, authors string, journal string, volume string, year int, doi string"
    done, links = ingest.upsert_papers(
        make(f"doc long, pos long, simulation_id long, {p_type}", *[tuple(p.values()) for p in papers]),
        make(f"id long, {p_type}", *[tuple(p.values()) for p in pubs]),
        spark.createDataFrame([], "id long, pub_id long, simulation_id long"),
    )
    want_pubs, want_links = replay_papers(pubs, papers)
    assert rows(done.table, "id", *FIELDS, "doi") == want_pubs
    assert sorted(tuple(r) for r in links.table.select("pub_id", "simulation_id").collect()) == want_links


# --- contributors ----------------------------------------------------------
@pytest.mark.parametrize("seed", range(2))
def test_contributors(make, seed):
    rnd = random.Random(seed)
    person = lambda: (
        rnd.choice(["", "n1", "n2"]), rnd.choice(["", "e1", "e2", None]), rnd.choice(["i", None]), rnd.choice(["", "", "o1", "o2"]), rnd.choice([None, None, 40]),
    )
    held = [(k, k % 3, *(v or "" for v in person()[:4]), 1) for k in range(7)]
    docs = [(f"d{k}", k % 4, [person() for _ in range(rnd.randrange(6))]) for k in range(6)]
    table, actions, rejects = ingest.upsert_contributors(
        make("doc string, simulation_id long, contributors array<struct<name:string,email:string,institution:string,orcid:string,rank:int>>", *docs),
        make("id long, simulation_id long, name string, email string, institution string, orcid string, rank int", *held),
    )
    names = ["id", "simulation_id", "name", "email", "institution", "orcid", "rank"]
    want, bad = [dict(zip(names, h)) for h in held], 0
    for _doc, sim, people in docs:
        for place, (name, email, inst, orcid, rank) in enumerate(people, 1):
            new = {"name": name or "", "email": email or "", "institution": inst or "", "orcid": orcid or "", "rank": rank or place}
            field = next((f for f in ("orcid", "email", "name") if new[f]), None)
            if field is None:
                bad += 1
                continue
            hit = min((w for w in want if w["simulation_id"] == sim and w[field] == new[field]), key=lambda w: w["id"], default=None)
            if hit is None:
                hit = {"id": max(w["id"] for w in want) + 1, "simulation_id": sim}
                want.append(hit)
            hit.update(new)
    assert rows(table, *names) == sorted((tuple(w[n] for n in names) for w in want), key=str)
    assert rejects.count() == bad
    before = {h[0]: h for h in held}
    assert actions.count() == sum(tuple(w[n] for n in names) != before.get(w["id"]) for w in want)


# --- simulations -----------------------------------------------------------
def replay_simulations(sims, docs):
    sims = [dict(s) for s in sims]
    for d in docs:
        ids = {s["id"] for s in sims}
        sim_id = None
        if d["simulation_id"]:
            if d["simulation_id"] not in ids:
                continue
            sim_id = d["simulation_id"]
        if sim_id is None and d["alias"] and d["owner_id"] is not None:
            sim_id = min((s["id"] for s in sims if s["alias"] == d["alias"] and s["created_by_id"] == d["owner_id"]), default=None)
        if sim_id is None:
            sim_id = min((s["id"] for s in sims if s["unique_file_hash_string"] == d["hash"]), default=None)
        new = {"unique_file_hash_string": d["hash"], "alias": d["alias"], "created_by_id": d["owner_id"], "is_placeholder": True, "is_deprecated": False}
        if sim_id is None:
            sims.append({"id": max(ids, default=0) + 1, **new, "is_public": False})
        else:
            next(s for s in sims if s["id"] == sim_id).update(new)
    return sims


SIM = ["id", "unique_file_hash_string", "alias", "created_by_id", "is_placeholder", "is_deprecated", "is_public"]
SIM_TYPE = "id long, unique_file_hash_string string, alias string, created_by_id long, is_placeholder boolean, is_deprecated boolean, is_public boolean, creation_date timestamp_ntz"
DOC_TYPE = "doc long, simulation_id long, alias string, owner_id long, hash string"


@pytest.mark.parametrize(("seed", "hashes", "n"), [(0, 14, 25), (1, 3, 60), (2, 200, 60), (3, 60, 200)])
def test_all_at_once_equals_one_document_after_the_other(make, seed, hashes, n):
    rnd = random.Random(seed)
    sims = [dict(zip(SIM, (k + 1, rnd.choice([f"h{k}", "h1", None]), rnd.choice([f"a{k % 3}", "", None]), rnd.choice([k % 2, None]), False, True, True))) for k in range(6)]
    docs = [
        {"doc": k, "simulation_id": rnd.choice([None] * 6 + [0, 2, 99]), "alias": rnd.choice([None, "", "a1", "a7", f"a{k}"]), "owner_id": rnd.choice([None, 0, 1]),
         "hash": f"h{rnd.randrange(hashes)}"}
        for k in range(n)
    ]
    shuffled = rnd.sample(docs, n)
    table = make(SIM_TYPE, *[(*s.values(), None) for s in sims])
    resolved = ingest.resolve_simulations(make(DOC_TYPE, *[tuple(d.values()) for d in shuffled]), table)
    new, actions = ingest.upsert_simulations(resolved, table, NOW)
    want = replay_simulations(sims, docs)
    assert rows(new, *SIM) == sorted((tuple(s[n] for n in SIM) for s in want), key=str)
    assert actions.count() == sum(d["simulation_id"] != 99 for d in docs) == resolved.where("step <> 'invalid'").count()
    assert actions.where("action = 'insert'").count() == len(want) - len(sims)


def test_many_documents_of_one_hash(make, spark):
    """A hot component; the first document makes the simulation, the others change it."""
    docs = spark.range(5000).selectExpr("id as doc", "cast(null as long) as simulation_id", "if(id % 2 = 0, concat('a', id % 7), null) as alias", "id % 3 as owner_id", "'h' as hash")
    resolved = ingest.resolve_simulations(docs, spark.createDataFrame([], SIM_TYPE))
    steps = {r["step"]: r["count"] for r in resolved.groupBy("step").count().collect()}
    assert steps["new"] == 1 and sum(steps.values()) == 5000
    assert rows(resolved, "sim_id")[0] == (1,) == rows(resolved, "sim_id")[-1]


def test_no_documents(make, spark):
    none = spark.createDataFrame([], DOC_TYPE)
    assert ingest.resolve_simulations(none, make(SIM_TYPE, (1, "h", "a", 1, False, True, True, None))).count() == 0


def test_owner(make):
    imports = make("doc long, lead_contributor_orcid string", (1, "o1"), (2, "0000-0000-0000-0000"), (3, "nobody"), (4, None))
    account = make("user_id long, provider string, uid string", (7, "orcid", "o1"), (5, "orcid", "o1"), (8, "github", "nobody"), (4, "orcid", "o1"))
    user = make("id long", (5,), (7,), (8,))
    known, unknown = ingest.resolve_owner(imports, account, user)
    assert rows(known, "doc", "owner_id") == [(1, 5), (2, None)]
    assert rows(unknown, "doc") == [(3,), (4,)]


def test_clear_for_reprocess(make):
    files = make("id long, simulation_id long", (1, 5), (2, 6))
    downloads = make("id long, simulationprocessedfile_id long", (10, 1), (11, 2))
    up = make("id long, simulationuploadedfile_id long", (20, 1))
    sims = make("simulation_id long", (5,))
    assert [rows(t, "id") for t in ingest.clear_for_reprocess(sims, files, downloads)] == [[(2,)], [(11,)]]
    assert [rows(t, "id") for t in ingest.clear_for_reprocess(sims, files, downloads, files, up)] == [[(2,)], [(11,)], [(2,)], []]


def test_whole_documents(spark, tmp_path):
    """Four documents: a new simulation, one that depends on it, a stranger, and one with a nameless contributor."""
    import json

    from simquarry.sources.documents import read_imports
    from simquarry.sources.tables import SCHEMAS

    base = {
        "lead_contributor_orcid": "o1", "software_name": "amber", "software_version": "22", "short_description": "s", "duration": 1, "sampling_frequency": 1,
        "integration_timestep_fs": 2, "rmsd_values": [1], "rmsf_values": [], "fasta_sequence": "A", "num_replicates": 1, "temperature_kelvin": 300,
        "processed_files": [{"name": "d/minimal.pdb", "file_type": "T", "size": 1, "md5_sum": "m"}], "replicates": ["r"], "contributors": [{"name": "n"}],
        "ligands": [{"name": "L", "smiles": "C"}], "solutes": [{"name": "Na", "concentration_mol_liter": 0.1}], "external_links": [{"url": "u"}],
        "papers": [{"title": "t", "authors": "a", "journal": "j", "volume": "1", "year": 2020, "doi": "d"}], "uniprots": [{"uniprot_id": "P1", "name": "n", "sequence": "AAA"}],
        "pdb": {"pdb_id": "1ABC", "title": "t", "classification": "c"},
    }
    for name, extra in {"a": {"unique_file_hash_string": "h1"}, "b": {"unique_file_hash_string": "h1", "alias": "x"}, "c": {"unique_file_hash_string": "h2", "lead_contributor_orcid": "zz"}, "d": {"unique_file_hash_string": "h3", "contributors": [{"name": "n"}, {"email": ""}]}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"simulation": {**base, **extra}}))
    docs, bad = read_imports(spark, str(tmp_path))
    assert bad.count() == 0
    tables = {t: spark.createDataFrame([], s) for t, s in SCHEMAS.items()}
    tables["user"] = spark.createDataFrame([(5, "u", None, None, None, None)], SCHEMAS["user"])
    tables["account"] = spark.createDataFrame([(5, "orcid", "o1")], SCHEMAS["account"])
    out, applied, rejects = ingest.ingest_documents(docs, tables, NOW)
    assert rows(out["simulation"], "id", "created_by_id", "software_id", "pdb_id", "is_placeholder", "is_public") == [(1, 5, 1, 1, True, False)]
    assert [out[t].count() for t in ("software", "processed_file", "uploaded_file", "replicate", "contribution", "ligand", "pub", "simulation_pub", "uniprot", "simulation_uniprot", "pdb")] == [1, 1, 0, 1, 1, 1, 1, 1, 1, 1, 1]
    assert rows(out["processed_file"], "simulation_id", "local_file_path") == [(1, "MDR00000001/processed/minimal.pdb")]
    assert rows(out["solute"], "name") == [("Na+",)] and rows(out["uniprot"], "amino_length") == [(3,)]
    assert sorted((r["doc"].rsplit("/", 1)[1], r["sim_id"], r["action"]) for r in applied.collect()) == [("a.json", 1, "insert"), ("b.json", 1, "update")]
    assert rows(out["simulation"], "alias") == [("x",)]
    assert sorted((r["doc"].rsplit("/", 1)[1], r["reason"]) for r in rejects.collect()) == [("c.json", "unknown lead contributor"), ("d.json", "contributor without a name")]
