"""Column functions on single values."""

import pytest
from pyspark.sql import functions as F

from simquarry.functions import rules, text


def values(make, schema, rows, column):
    return [r[0] for r in make(schema, *rows).select(column).collect()]


def test_human_bytes(make):
    cases = {
        0: "0.0 B", 1023: "1023.0 B", 1024: "1.0 KB", 1280: "1.2 KB", 1792: "1.8 KB", 1024**2: "1.0 MB",
        5 * 1024**3: "5.0 GB", 1024**4: "1.0 TB", 3 * 1024**5: "3.0 PB", None: None,
    }
    got = values(make, "n long", [(n,) for n in cases], text.human_bytes(F.col("n")))
    assert got == list(cases.values())


def test_human_bytes_rounds_like_python(make):
    sizes = [k * 64 + j for k in range(16, 400) for j in (0, 1, 31)]
    got = values(make, "n long", [(n,) for n in sizes], text.human_bytes(F.col("n")))
    assert got == [f"{n / 1024:.1f} KB" for n in sizes]


def test_format_hm(make):
    cases = {
        None: None, 0.0: "<1m", 59.9: "<1m", 60.0: "1m", 2100.0: "35m", 1847.26: "30m", 3600.0: "1h 0m",
        8100.0: "2h 15m", 45240.0: "12h 34m", 93900.0: "26h 5m",
    }
    assert values(make, "s double", [(s,) for s in cases], text.format_hm(F.col("s"))) == list(cases.values())


def test_repo_id_keeps_long_numbers(make):
    got = values(make, "i long", [(7,), (12345678,), (1234567890,)], text.repo_id(F.col("i")))
    assert got == ["MDR00000007", "MDR12345678", "MDR1234567890"]


def test_landing_name(make):
    got = values(make, "c string", [("/z/a/L1",), ("/z/a/L1//",), ("L1",)], text.landing_name(F.col("c")))
    assert got == ["L1"] * 3


@pytest.mark.parametrize(
    "entry, regex, split",
    [
        ("MDRSubmit_L1:/z/L1", ("L1", "/z/L1"), ("L1", "/z/L1")),
        ("MDRSubmit_L1:/z/a:b", ("L1", "/z/a:b"), ("a", "/z/a")),
        ("other_L1:/z/L1", (None, None), ("L1", "/z/L1")),
        ("MDRSubmit_:/z/L1", (None, None), ("L1", "/z/L1")),
        ("MDRSubmit_L1:", (None, None), ("", "")),
        ("xMDRSubmit_L1:/z", (None, None), ("z", "/z")),
        ("none", (None, None), (None, None)),
    ],
)
def test_ticket_entry(make, entry, regex, split):
    for mode, want in (("regex", regex), ("split", split)):
        landing, collection, ok = text.ticket_entry(F.col("e"), mode)
        row = make("e string", (entry,)).select(landing, collection, ok).first()
        assert tuple(row) == (*want, want[1] is not None)


def test_tail_lines(make):
    body = "\n".join(str(k) for k in range(30)) + "\n"
    got = values(make, "t string", [(body,), ("a\nb",), ("",), ("  x \n",)], text.tail_lines(F.col("t"), 3))
    assert got == ["27\n28\n29", "a\nb", "", "x"]


def test_slug(make):
    got = values(make, "t string", [("Push (prod)!",), ("###",), ("a--B",)], text.slug(F.col("t")))
    assert got == ["push-prod", "job", "a-b"]


def test_norm_md5(make):
    got = values(make, "t string", [("md5: AB12 ",), ("ab",), ("sha2:x:Y",), (None,)], text.norm_md5(F.col("t")))
    assert got == ["ab12", "ab", "x:y", None]


def test_permanent_path(make):
    rows = [(5, "original", "d/x.nc"), (5, "processed", "d/x.nc")]
    got = values(make, "i long, k string, n string", rows, text.permanent_path(F.col("i"), F.col("k"), F.col("n")))
    assert got == ["MDR00000005/original/d/x.nc", "MDR00000005/processed/x.nc"]


def test_extension_and_stem(make):
    df = make("p string", ("/a/b.c/x.tar.GZ",), ("x",), (".bashrc",), ("/d/y.top",))
    got = [tuple(r) for r in df.select(text.extension(F.col("p")), text.stem(F.col("p")), text.dirname(F.col("p"))).collect()]
    assert got == [(".gz", "x.tar", "/a/b.c"), ("", "x", "."), ("", ".bashrc", "."), (".top", "y", "/d")]


def test_one_line(make):
    got = values(make, "t string", [("  a \n\t b ",), ("x" * 600,), (None,)], text.one_line(F.col("t")))
    assert got == ["a b", "x" * 500, ""]


def test_retryable_text(make):
    cases = {
        "\x1b[31mFailed to establish a connection to iRODS server\x1b[0m": True,
        "irods.exception.NetworkException: x": True, "code -344000 EXEC_CMD_ERROR": True, "bad topology": False, None: False,
    }
    got = values(make, "t string", [(t,) for t in cases], rules.is_retryable(F.col("t")))
    assert got == list(cases.values())


def test_back_off_table(make):
    df = make("n int, f string", *[(n, "2024-01-01 00:00:00") for n in (0, 1, 2, 3, 4, 9, 40)])
    at = rules.eligible_at(F.col("f").cast("timestamp_ntz"), F.col("n"))
    got = [r[0] for r in df.select(F.timestamp_diff("MINUTE", F.col("f").cast("timestamp_ntz"), at)).collect()]
    assert got == [5, 5, 20, 80, 180, 180, 180]


def test_background(make):
    cases = {
        "ALA": True, "hie": True, "DA": True, "SOL": True, "POPC": True, "NA+": True, "MG2+": True, "CL-": True,
        "LIG": False, "": False, None: False, "ATP": False, "CA": True,
    }
    got = values(make, "r string", [(r,) for r in cases], rules.is_background(F.col("r")))
    assert got == list(cases.values())


def test_amino_letters(make):
    cases = {"ALA": "A", "hie": "H", "ACE": "", "SEP": "S", "SEC": "U", "COV": "X", "ASX": "B", "LIG": "", " gly ": "G", None: ""}
    assert values(make, "r string", [(r,) for r in cases], rules.aa1(F.col("r"))) == list(cases.values())


def test_infer_element(make):
    cases = [
        (("HG21", "Hg"), 80), (("C5R", "na"), 6), (("N1", ""), 7), (("ZN", "ZN"), 30), (("Cl1", ""), 6),
        (("BR", None), 35), (("1HB", None), 0), (("", "Fe"), 26), (("K", ""), 19), (("X1", None), 0),
    ]
    got = values(make, "n string, e string", [c for c, _ in cases], rules.infer_element(F.col("n"), F.col("e")))
    assert got == [z for _, z in cases]


def test_has_box(make):
    rows = [(None,), ([0.0] * 6,), ([1e-7] * 3,), ([0.0, -2.0],)]
    assert values(make, "b array<double>", rows, rules.has_box(F.col("b"))) == [False, False, False, True]


def test_format_by_ext(make):
    rows = [(["a.PRMTOP", "b.psf"],), (["a.psf"],), (["a.prm", "a.top"],), (["a.gro", None],), (["a.x"],)]
    got = values(make, "f array<string>", rows, rules.format_by_ext(F.col("f")))
    assert got == ["amber", "namd", "charmm", "gromacs", None]


def sniff(path: str, data: bytes):
    """The rule in plain Python."""
    import re

    table = {"tpr": "TPR", "top": "ITP", "prmtop": "TOP"}
    head = data[:4096]
    if not head:
        return None
    if sum(9 <= b <= 126 for b in head) / len(head) < 0.85:
        return table.get(path.rsplit(".", 1)[-1].lower())
    lines = head.decode("utf-8", errors="replace").splitlines()
    if any(re.match(r"\s*\[\s*(defaults|atomtypes|moleculetype|system|molecules)\s*\]", k) for k in lines):
        return "ITP"
    if any(k.startswith(("ATOM  ", "HETATM", "HEADER", "CRYST1", "MODEL ", "REMARK", "TITLE ", "COMPND")) for k in lines):
        return "PDB"
    if len(lines) > 1:
        try:
            int(lines[1].strip())
            return "GRO"
        except ValueError:
            pass
    return None


def test_format_by_content(make):
    files = [
        ("a.gro", b""), ("a.tpr", bytes(range(128, 250)) * 40), ("a.xyz", b"\x00" * 50), ("a.gro", b"; c\n [ system ]\nx"),
        ("a.top", b"t\n 12 \n"), ("a.top", b"t\r\n+12\r\nx"), ("a.pdb", b"x\nHETATM  1"), ("a.pdb", b"x\ny\n"), ("a.gro", b"t\n1.5\n"),
        ("a.x", "é".encode() * 100), ("a.prmtop", "é".encode() * 100), ("a.q", b"x" * 4090 + b"\nATOM  "), ("a.q", b"x" * 4095 + b"\nATOM  1"),
        ("a.q", "t\x85 7\n".encode()), ("a.q", "t  8\n".encode()), ("a.q", b"[ atoms ]\n[ molecules ]"),
    ]
    got = values(make, "p string, c binary", [(p, bytearray(c)) for p, c in files], rules.format_by_content(F.col("p"), F.col("c")))
    assert got == [sniff(p, c) for p, c in files]


def test_junk_names(make):
    cases = {
        "3805-37-6": True, "8hvp": True, "ABCDEFGHIJKLMN-ABCDEFGHIJ-K": True, "CHEBI:1": True, "x" * 81: True, "y" * 31: True,
        "A2P5P": True, "orb1702635": True, "ATP": False, "aspirin": False, "Vitamin B12": False, "Vit12b": False, " ": True, None: True,
    }
    assert values(make, "n string", [(n,) for n in cases], rules.is_junk(F.col("n"))) == list(cases.values())


def test_inchi_layers(make):
    row = make("i string", ("InChI=1S/C2H6O/c1-2-3/h3H,2H2,1H3/t1-/t2-/+1//q-1",)).select(rules.inchi_layers(F.col("i"))).first()[0]
    assert row == {
        "raw": "InChI=1S/C2H6O/c1-2-3/h3H,2H2,1H3/t1-/t2-/+1//q-1", "formula": "C2H6O", "c": "c1-2-3",
        "h": "h3H,2H2,1H3", "t": "t2-", "p": "+1", "q": "q-1",
    }
    empty = make("i string", ("",), (None,)).select(rules.inchi_layers(F.col("i"))).collect()
    assert [r[0] for r in empty] == [{"raw": ""}, None]


def test_job_notice(make):
    df = make(
        "o string, s double, c int, m string", ("succeeded", 2100.0, 0, None), ("succeeded", None, 0, None),
        ("failed", 10.0, 3, ""), ("failed", None, None, None), ("killed", 43200.0, None, "Too long"),
    )
    note = rules.job_notice(F.lit(9), F.col("o"), F.col("s"), F.col("c"), F.col("m"), F.lit("/job/1"), F.lit("/l"))
    assert [r[0] for r in df.select(note).collect()] == [
        "Ticket 9 processing SUCCEEDED in 35m",
        "Ticket 9 processing SUCCEEDED",
        "Ticket 9 processing FAILED (exit 3) after <1m\nDetails: /job/1\nDebug log: /l",
        "Ticket 9 processing FAILED\nDetails: /job/1\nDebug log: /l",
        "Ticket 9 processing KILLED (exceeded time limit) after 12h 0m\nToo long\nDetails: /job/1\nDebug log: /l",
    ]
