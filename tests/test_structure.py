"""Residues, sequences, chains, sibling files and trajectories."""

from functools import reduce
from operator import and_

import numpy as np
import pytest
from pyspark.sql import functions as F

from simquarry.functions import rules
from simquarry.operators import molecules, structure, trajectory


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# --- residues --------------------------------------------------------------
def test_first_residue_prefers_the_exact_name(make):
    atoms = make(
        "sim_id long, atom_id long, resname string, resix long",
        (1, 1, "lig", 1), (1, 2, "LIG", 5), (1, 3, "LIG", 5), (1, 4, "LIG", 9), (2, 5, "lig", 3), (2, 6, "Lig", 3), (2, 7, "lig", 4),
    )
    targets = make("sim_id long, target string", (1, "LIG"), (2, "LIG"), (3, "LIG"))
    assert rows(structure.first_residue(atoms, targets), "sim_id", "atom_id") == [(1, 2), (1, 3), (2, 5), (2, 6)]


def test_targets(make):
    atoms = make("sim_id long, resname string", (1, "LIG"), (1, "ALA"), (1, "XYZ"), (2, "ALA"), (3, "SOL"), (4, "ABC"))
    wanted = make("sim_id long, wanted string", (1, "LIG"), (2, "LIG"), (3, None), (4, "LIG"))
    assert rows(structure.target_resnames(atoms, wanted)) == sorted([
        (1, "LIG", None), (2, None, "name absent and no candidate"), (3, None, "no candidate"), (4, "ABC", None),
    ], key=str)
    assert rows(structure.target_resnames(atoms, make("sim_id long, wanted string", (2, "ALA"), (1, "ala")))) == sorted([
        (2, "ALA", None), (1, "LIG", None), (1, "XYZ", None),
    ], key=str)


def test_sequences(make):
    """Numbers count a dropped chain, models are appended, caps vanish."""
    cols = "sim_id string, model int, record string, chain string, residue string, resname string, line_no long"
    a = make(
        cols,
        ("s", 1, "HETATM", "C", "9", "LIG", 1),  # first line of chain C
        ("s", 1, "ATOM", "A", "1", "ACE", 2), ("s", 1, "ATOM", "A", "2", "ALA", 3), ("s", 1, "ATOM", "A", "2", "ALA", 4), ("s", 1, "ATOM", "A", "3", "HIE", 5),
        ("s", 1, "ATOM", "B", "1", "COV", 6), ("s", 1, "ATOM", "B", "2", "XAA", 7),
        ("s", 1, "ATOM", "C", "1", "SEP", 8), ("s", 1, "HETATM", "C", "2", "GLY", 9), ("s", 1, "ATOM", " ", "1", "TRP", 10),
        ("s", 2, "ATOM", "A", "2", "GLY", 11),
        ("t", 1, "HETATM", "A", "1", "ALA", 1), ("t", 1, "ATOM", "A", "2", "SOL", 2),
    )
    assert rows(structure.chain_sequences(a), "sim_id", "chain", "number", "sequence", "error") == sorted([
        ("s", "C", 1, "S", None), ("s", "A", 2, "AHG", None), ("s", "_", 4, "W", None), ("t", None, None, None, "no sequence"),
    ], key=str)
    one = structure.chain_sequences(a, first_model_only=True)
    assert rows(one.where("chain = 'A'"), "sequence") == [("AH",)]


def test_long_chain_keeps_its_order(spark):
    n = 20000
    a = spark.range(n).select(
        F.lit(1).alias("sim_id"), F.lit("A").alias("chain"), F.col("id").cast("string").alias("residue"),
        F.when(F.col("id") % 3 == 0, "ALA").when(F.col("id") % 3 == 1, "GLY").otherwise("TRP").alias("resname"), F.col("id").alias("line_no"),
    ).repartition(11)
    assert structure.chain_sequences(a).first()["sequence"] == ("AGW" * n)[:n]


def test_restore_chains(make):
    ref = make("sim_id long, resnum int, chain string, line_no long", (1, 1, "A", 1), (1, 1, "B", 2), (1, 2, " ", 3), (1, None, "Z", 4), (1, 3, "C", 5), (1, 3, "", 6))
    target = make("sim_id long, atom_id long, resnum int, chain string", (1, 1, 1, " "), (1, 2, 2, "q"), (1, 3, 3, " "), (1, 4, None, "k"), (2, 5, 1, "m"))
    assert rows(structure.restore_chains(target, ref), "atom_id", "chain") == [(1, "B"), (2, "q"), (3, "C"), (4, "k"), (5, "m")]


def test_siblings(make):
    f = lambda *p: make("path string", *[(x,) for x in p])
    top = lambda files: dict(rows(structure.match_sibling(files, ".gro", ".top", "prefix")))
    assert top(f("/d/a.gro", "/d/a.top", "/d/ab.top")) == {"/d/a.gro": "/d/a.top"}
    assert top(f("/d/abc.gro", "/d/ab.top", "/d/x.top")) == {"/d/abc.gro": "/d/ab.top"}
    assert top(f("/d/a.gro", "/d/a_long.top", "/d/x.top")) == {"/d/a.gro": "/d/a_long.top"}
    assert top(f("/d/q.gro", "/d/x.top")) == {"/d/q.gro": "/d/x.top"}
    assert top(f("/d/q.gro", "/d/x.top", "/d/y.top", "/e/q.top")) == {"/d/q.gro": None}
    assert top(f("/d/q.gro")) == {"/d/q.gro": None}
    exact = lambda files: dict(rows(structure.match_sibling(files, ".xtc", ".tpr")))
    assert exact(f("/d/a.xtc", "/d/ab.tpr", "/d/c.tpr")) == {"/d/a.xtc": None}
    assert exact(f("a.xtc", "b.tpr")) == {"a.xtc": "b.tpr"}


def test_missing_extensions(make):
    sims = make("simulation_id long, software string", (1, "Amber"), (2, "NAMD"), (3, "other"), (4, "gromacs"))
    files = make("simulation_id long, filename string", (1, "a.nc"), (2, "a.nc"), (2, "x"), (3, "y"))
    assert rows(structure.missing_exts(sims, files), "simulation_id") == [(2,), (4,)]


def test_software_table(spark):
    df = structure.software_extensions(spark)
    assert df.count() == 28 and rows(df.where("software = 'lammps'"), "extension") == [(".data",), (".dump",)]


def test_time_axis(make):
    logs = make(
        "run_id string, line_no long, line string",
        ("a", 1, "x"), ("a", 2, "'t.nc' is a NetCDF trajectory with coordinates, time, box, Parm p.prmtop (box)"), ("a", 3, "q is a f with box"),
        ("b", 1, "t is a f with coordinates, box, Parm a, time, b (x)"), ("c", 1, "t is a f with coordinates, time."), ("d", 1, "nothing with time"),
    )
    assert rows(structure.time_axis(logs)) == [("a", True), ("b", False), ("c", True), ("d", None)]


# --- trajectories ----------------------------------------------------------
@pytest.fixture(scope="module")
def frames():
    """Two simulations of rigidly moved, slightly shaken points."""
    rng = np.random.default_rng(5)
    out = {}
    for sim, n_atoms in ((1, 9), (2, 4)):
        base = rng.normal(size=(n_atoms, 3)) * [5, 2, 1] + 40
        track = [base]
        for _ in range(12):
            q, _r = np.linalg.qr(rng.normal(size=(3, 3)))
            track.append((base + rng.normal(size=base.shape) * 0.3) @ (q * np.sign(np.linalg.det(q))) + rng.normal(size=3) * 10)
        track.append(base * [1, 1, -1])  # a mirror image must not be flipped
        out[sim] = np.array(track)
    return out


@pytest.fixture(scope="module")
def coords(spark, frames):
    data = [
        (sim, f, a, *map(float, xyz)) for sim, track in frames.items() for f, frame in enumerate(track) for a, xyz in enumerate(frame)
    ]
    return spark.createDataFrame(data, "sim_id long, frame long, atom_id long, x double, y double, z double").repartition(5)


def kabsch(p, r):
    pc, rc = p - p.mean(0), r - r.mean(0)
    u, _s, vt = np.linalg.svd(pc.T @ rc)
    rot = vt.T @ np.diag([1, 1, np.sign(np.linalg.det(u @ vt))]) @ u.T
    return pc @ rot.T + r.mean(0)


def dist(a, b):
    return np.sqrt(((a - b) ** 2).sum(1).mean())


def test_rmsd(coords, frames):
    got = {(r["sim_id"], r["frame"]): r["rmsd"] for r in trajectory.rmsd(coords).collect()}
    for sim, track in frames.items():
        for f, frame in enumerate(track):
            assert got[sim, f] == pytest.approx(dist(kabsch(frame, track[0]), track[0]), abs=1e-5)


def test_frames_far_from_the_origin(coords, frames):
    """A shift of all frames by 30,000 changes neither the fit nor the axes."""
    far = coords.selectExpr("sim_id", "frame", "atom_id", *[f"{c} + 3e4 as {c}" for c in "xyz"])
    got = {(r["sim_id"], r["frame"]): r["rmsd"] for r in trajectory.rmsd(far).collect()}
    moved = trajectory.superpose(far, trajectory.first_frame(far))
    near, away = (trajectory.orient_reference(trajectory.first_frame(c)) for c in (coords, far))
    for sim, track in frames.items():
        want = np.array([kabsch(f, track[0]) for f in track])
        assert [got[sim, f] for f in range(1, len(track))] == pytest.approx([dist(w, track[0]) for w in want[1:]], abs=1e-6)
        assert got[sim, 0] == pytest.approx(0, abs=1e-4)
        assert to_array(moved, sim) - 3e4 == pytest.approx(want, abs=1e-6)
        a, b = to_array(near, sim)[0], to_array(away, sim)[0]
        assert a - a.mean(0) == pytest.approx(b - b.mean(0), abs=1e-6)


def test_series_that_start_later(coords, frames):
    """The reference is the first frame that each simulation has."""
    late = coords.where("frame >= 5 + sim_id")
    got = {(r["sim_id"], r["frame"]): r["rmsd"] for r in trajectory.rmsd(late).collect()}
    for sim, track in frames.items():
        for f in range(5 + sim, len(track)):
            assert got.pop((sim, f)) == pytest.approx(dist(kabsch(track[f], track[5 + sim]), track[5 + sim]), abs=1e-5)
    assert not got
    assert rows(trajectory.first_frame(late).select("sim_id", "frame").distinct()) == [(s, 5 + s) for s in sorted(frames) if len(frames[s]) > 5 + s]


def test_rmsd_degenerate(make):
    """One atom, and atoms on a line."""
    one = make("sim_id long, frame long, atom_id long, x double, y double, z double", (1, 0, 0, 1.0, 2.0, 3.0), (1, 1, 0, 9.0, 9.0, 9.0),
               *[(2, f, a, float(a), 0.0, float(f)) for f in range(2) for a in range(3)])
    assert [r["rmsd"] for r in trajectory.rmsd(one).collect()] == pytest.approx([0] * 4, abs=1e-5)


def test_rmsf(coords, frames):
    got = {(r["sim_id"], r["atom_id"]): r["rmsf"] for r in trajectory.rmsf(coords).collect()}
    for sim, track in frames.items():
        want = np.sqrt(track.var(0).sum(1))
        assert [got[sim, a] for a in range(track.shape[1])] == pytest.approx(list(want))


def to_array(df, sim):
    data = sorted((r["frame"], r["atom_id"], r["x"], r["y"], r["z"]) for r in df.where(f"sim_id = {sim}").collect())
    n = len({d[0] for d in data})
    return np.array([d[2:] for d in data]).reshape(n, -1, 3)


def test_superpose(coords, frames):
    moved = trajectory.superpose(coords, trajectory.first_frame(coords))
    for sim, track in frames.items():
        want = np.array([kabsch(f, track[0]) for f in track])
        assert to_array(moved, sim) == pytest.approx(want, abs=1e-8)


def test_superpose_by_some_atoms(coords, frames, make):
    fit = make("sim_id long, atom_id long", *[(s, a) for s in (1, 2) for a in (0, 1, 3)])
    moved = to_array(trajectory.superpose(coords, trajectory.first_frame(coords), fit), 1)
    track = frames[1]
    picked = [0, 1, 3]
    for f, frame in enumerate(track):
        assert dist(moved[f][picked], kabsch(frame[picked], track[0][picked])) < 1e-8
        gap = lambda m: np.linalg.norm(m[:, None] - m[None], axis=2)
        assert gap(moved[f]) == pytest.approx(gap(frame), abs=1e-8)


def test_orientation(coords, frames):
    turned = trajectory.orient_reference(trajectory.first_frame(coords))
    for sim, track in frames.items():
        got = to_array(turned, sim)[0]
        centred = got - got.mean(0)
        moments = centred.T @ centred
        values = np.sort(np.linalg.eigvalsh((track[0] - track[0].mean(0)).T @ (track[0] - track[0].mean(0))))
        # Longest along z, second along x, shortest along y.
        assert np.diag(moments) == pytest.approx([values[1], values[0], values[2]], rel=1e-6)
        gap = lambda m: np.linalg.norm(m[:, None] - m[None], axis=2)
        assert gap(got) == pytest.approx(gap(track[0]))
        # A turn, not a mirror image.
        a = np.linalg.lstsq(track[0], got, rcond=None)[0]
        assert np.linalg.det(a) == pytest.approx(1, abs=1e-6)


def test_minimal(coords, frames, make):
    atoms = make("sim_id long, atom_id long, name string, resname string", *[(1, a, "CA" if a < 4 else "O", "SOL" if a == 8 else "POPC" if a == 7 else "ALA") for a in range(9)],
                 *[(2, a, "X", "ALA") for a in range(4)])
    fitted, first = trajectory.minimal(atoms, coords)
    got = to_array(fitted, 1)
    assert got.shape == (14, 7, 3) and to_array(fitted, 2).shape == (14, 4, 3)
    track = frames[1]
    for f in range(14):
        assert dist(got[f][:4], got[0][:4]) == pytest.approx(dist(kabsch(track[f][:4], track[0][:4]), track[0][:4]), abs=1e-6)
    assert to_array(first, 1)[0] == pytest.approx(got[0])
    fitted, _first = trajectory.minimal(atoms, coords, keep_lipids=True)
    assert rows(fitted.select("sim_id", "atom_id").distinct()) == [(1, a) for a in range(8)]


def test_stride_sample(spark):
    for n, step in ((1000, 1), (1001, 1), (1999, 1), (2000, 2), (3500, 3)):
        df = spark.range(n).selectExpr("1 as k", "id * 2 as at")
        got = [r["at"] for r in trajectory.stride_sample(df, "k", "at").orderBy("at").collect()]
        values = [2 * k for k in range(n)]
        assert got == (values[:: n // 1000] if n > 1000 else values), (n, step)


def test_sample_frames(spark):
    for n in (50, 100, 101, 250, 1000, 1700):
        df = spark.range(n).selectExpr("1 as sim_id", "id * 10 as frame", "0 as atom_id")
        got = [r["frame"] // 10 for r in trajectory.sample_frames(df).orderBy("frame").collect()]
        end = min(n, 1000)
        assert got == list(range(end))[:: end // 100 if end > 100 else 1]


def test_gate(make):
    sims = make("sim_id long", (1,), (2,), (3,), (4,))
    values = make("sim_id long, value double", (1, 500.0), (1, 3.0), (2, 500.1), (4, None))
    assert rows(trajectory.gate(values, sims), "sim_id", "accepted", "reason") == [
        (1, True, None), (2, False, "above the limit"), (3, False, "no values"), (4, False, "no values"),
    ]


# --- molecules -------------------------------------------------------------
def test_compare(make):
    pairs = make(
        "k int, canonical1 string, inchi1 string, canonical2 string, inchi2 string",
        (1, "C", "InChI=1S/CH4/c1/h1H4", "C", "InChI=1S/CH4/c1/h1H4"),
        (2, "C", "InChI=1S/CH4/c1-2/h1H4/t1-/m0", "D", "InChI=1S/CH3/c1-2/h1H3/q+1/p+1/t2-/m1/b3-"),
        (3, "C", "InChI=1S/CH4", "C", "InChI=1S/CH4"),
        (4, "C", "InChI=1S/CH4/c1-2", "C", "InChI=1S/CH4/c1-3"),
    )
    got = rows(molecules.compare_molecules(pairs), "k", "exact_match", "same_connectivity", "same_connectivity_and_stereo", "same_inchi", "differences", "connectivity_layer")
    different = ["connectivity (different molecules)"]
    assert got == [
        (1, True, True, True, True, [], "c1"),
        (2, False, True, False, False, ["formula (CH4 vs CH3)", "hydrogen attachment", "charge", "protonation", "tetrahedral stereo", "E/Z stereo"], "c1-2"),
        (3, True, False, False, True, different, None),
        (4, True, False, False, False, different, None),
    ]


def test_groups_agree_with_pairs(make):
    mols = make("mol_id long, canonical string, inchi string", (1, "a", "InChI=1S/X/c1/t1-"), (2, "b", "InChI=1S/X/c1/t1+"), (3, "a", "InChI=1S/X"), (4, "c", "InChI=1S/X"), (5, "d", "InChI=1S/X/c1/t1-/p+1"))
    group = lambda level: {r["mol_id"]: (r["group_id"], r["group_size"]) for r in molecules.identity_groups(mols, level).collect()}
    assert group("connectivity") == {1: (1, 3), 2: (1, 3), 5: (1, 3), 3: (3, 1), 4: (4, 1)}
    assert group("stereo") == {1: (1, 2), 5: (1, 2), 2: (2, 1), 3: (3, 1), 4: (4, 1)}
    assert group("exact") == {1: (1, 2), 3: (1, 2), 2: (2, 1), 4: (4, 1), 5: (5, 1)}
    assert group("inchi")[3] == (3, 2)


def test_best_name_order(make):
    mols = make(
        "k int, label string, synonym string, compound_name string, title string",
        (1, "adenosine", "syn", "comp", "tit"), (2, "ATP", "syn", None, None), (3, "ATP", None, "comp", None), (4, "A2P5P", None, "comp", "tit"),
        (5, None, None, None, "tit"), (6, None, "", "", None),
    )
    assert rows(molecules.best_names(mols), "k", "best_name", "name_source") == [
        (1, "adenosine", "wikidata"), (2, "syn", "pubchem_synonyms"), (3, "ATP", "wikidata"), (4, "comp", "pdbe"), (5, "tit", "pubchem_title"), (6, "unknown", None),
    ]


def test_best_synonym(make):
    s = make("mol_id long, pos long, synonym string", (1, 0, "50-00-0"), (1, 1, "CHEBI:1"), (1, 2, "formalin"), (1, 3, "methanal"), (2, 0, "1abc"), *[(3, k, f"n {k}") for k in range(15)])
    got = {r["mol_id"]: (r["synonym"], r["evidence"]) for r in molecules.best_synonym(s).collect()}
    assert got[1] == ("formalin", ["50-00-0", "CHEBI:1", "formalin", "methanal"]) and got[2][0] is None
    assert got[3][1] == [f"n {k}" for k in range(10)]


def test_checked_batch(make):
    df = make("b int, pos int, smiles string, ok boolean", (1, 0, "C", True), (1, 1, "N", True), (2, 0, "C", True), (2, 1, "Q", False), (2, 2, "W", None))
    good, bad = molecules.checked_batch(df, "b", "pos", "smiles", F.col("ok"))
    assert rows(good, "b", "pos") == [(1, 0), (1, 1)] and rows(bad) == [(2, "Q", 1)]


def test_layer_by_letter_equals_the_map(make):
    odd = ["InChI=1S/CH4/c1-2/h1H/t1-/c9", "InChI=1S/X", "InChI=1S", "", "c1/c2/c3", "a/b/+1/-2/p3/C4/c5", "InChI=1S/C1//c/t2", None]
    df = make("inchi string", *[(x,) for x in odd])
    layers = rules.inchi_layers(F.col("inchi"))
    same = [rules.layer(layers, k) == rules.inchi_layer(F.col("inchi"), k) for k in "ctbmhq"]
    assert df.where(~reduce(and_, same)).count() == 0 and df.count() == len(odd)


def test_keys_of_molecules_build_no_map(make):
    mols = make("mol_id long, canonical string, inchi string", (1, "a", "InChI=1S/X/c1/t1-"))
    plan = molecules.identity_groups(mols, "stereo")._jdf.queryExecution().toString()
    assert "map_from_entries" not in plan
