"""Column functions that state rules: queue, formats, residues, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions.text import blank, extension, format_hm, norm_md5, strip


# --- queue -----------------------------------------------------------------
def eligible_at(
    finished_at: Column,
    attempts: Column,
    base: int = fv.BACKOFF_BASE_MIN,
    factor: int = fv.BACKOFF_FACTOR,
    cap: int = fv.BACKOFF_CAP_MIN,
) -> Column:
    """When a job that went back to pending may run again."""
    steps = F.greatest(attempts - 1, F.lit(0))
    minutes = F.least(F.lit(float(base)) * F.pow(F.lit(float(factor)), steps), F.lit(float(cap)))
    return F.timestamp_add("MINUTE", minutes.cast("int"), finished_at)


def claimable(status: Column, finished_at: Column, attempts: Column, now: Column) -> Column:
    return (status == "pending") & (finished_at.isNull() | (eligible_at(finished_at, attempts) <= now))


def is_retryable(detail: Column) -> Column:
    low, out = F.lower(F.coalesce(detail, F.lit(""))), F.lit(False)
    for text in fv.RETRYABLE_TEXT:
        out = out | low.contains(text)
    return out


def job_notice(
    ticket_id: Column,
    outcome: Column,
    seconds: Column,
    exit_code: Column,
    summary: Column,
    job_link: Column,
    log_file: Column,
) -> Column:
    """Notice of a finished job; ``outcome`` is succeeded, failed or killed."""
    head = F.concat(F.lit("Ticket "), ticket_id.cast("string"), F.lit(" processing "))
    took = format_hm(seconds)
    good = F.concat(head, F.lit("SUCCEEDED"), F.coalesce(F.concat(F.lit(" in "), took), F.lit("")))
    verb = F.when(outcome == "killed", "KILLED (exceeded time limit)").otherwise("FAILED")
    note = F.when(
        (outcome == "failed") & exit_code.isNotNull(),
        F.concat(F.lit(" (exit "), exit_code.cast("string"), F.lit(")")),
    ).otherwise("")
    bad = F.concat_ws(
        "\n",
        F.concat(head, verb, note, F.coalesce(F.concat(F.lit(" after "), took), F.lit(""))),
        F.when(~blank(summary), summary),
        F.concat(F.lit("Details: "), job_link),
        F.concat(F.lit("Debug log: "), log_file),
    )
    return F.when(outcome == "succeeded", good).otherwise(bad)


# --- checksums -------------------------------------------------------------
def copy_state(found: Column, size: Column, md5: Column, want_size: Column, want_md5: Column) -> Column:
    """missing, size, md5 or ok.  A checksum that is not known never verifies."""
    return (
        F.when(~F.coalesce(found, F.lit(False)), "missing")
        .when(~size.eqNullSafe(want_size), "size")
        .when(F.coalesce(md5 == want_md5, F.lit(False)), "ok")
        .otherwise("md5")
    )


def push_state(found: Column, size: Column, checksum: Column, want_size: Column, want_md5: Column):
    """Presence, verdict and reason for one pushed file."""
    present = F.coalesce(found, F.lit(False)) & F.coalesce(size == want_size, F.lit(False))
    digest = F.when(present & ~blank(checksum), norm_md5(checksum))
    verified = present & F.coalesce(digest == F.lower(F.coalesce(want_md5, F.lit(""))), F.lit(False))
    reason = (
        F.when(verified, F.lit(None).cast("string"))
        .when(~present, "missing")
        .when(digest.isNull(), "no checksum available")
        .otherwise("md5 mismatch")
    )
    return present, digest, verified, reason


# --- file formats ----------------------------------------------------------
def format_by_ext(names: Column) -> Column:
    """Simulation format from an array of file names, fixed precedence."""
    exts = F.transform(F.filter(names, lambda n: n.isNotNull()), extension)
    out = None
    for fmt, known in fv.FORMAT_EXTENSIONS.items():
        hit = F.arrays_overlap(exts, F.array(*[F.lit(e) for e in known]))
        out = F.when(hit, fmt) if out is None else out.when(hit, fmt)
    return out


def reader_format(ext: Column) -> Column:
    """Reader name for an extension without its dot."""
    table = F.create_map(*[F.lit(x) for pair in fv.READER_FORMATS.items() for x in pair])
    return F.try_element_at(table, ext)


def format_by_content(path: Column, content: Column) -> Column:
    """Topology format from the first 4096 bytes of a file.

    The head is read as ISO-8859-1, one character per byte, which keeps the
    byte counts and every ASCII pattern.
    """
    head = F.substring(content, 1, 4096)
    text = F.decode(head, "ISO-8859-1")
    share = F.length(F.regexp_replace(text, r"[^\x09-\x7e]", "")) / F.length(text)
    # Line ends as a text reader sees them, the two- and three-byte ones included.
    lines = F.split(text, "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e]|Â\u0085|â\u0080[¨©]")
    second = strip(F.get(lines, 1))
    record = F.exists(
        lines, lambda s: F.substring(s, 1, 6).isin(*fv.PDB_RECORDS)
    )
    return (
        F.when(F.coalesce(F.length(head), F.lit(0)) == 0, F.lit(None).cast("string"))
        .when(share < 0.85, reader_format(F.substring(extension(path), F.lit(2), F.length(path))))
        .when(F.exists(lines, lambda s: s.rlike(fv.TOPOLOGY_SECTION)), "ITP")
        .when(record, "PDB")
        .when(second.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), "GRO")
    )


# --- residues and atoms ----------------------------------------------------
_BACKGROUND = fv.AMINO_ACIDS + fv.NUCLEOTIDES + fv.WATERS + fv.LIPIDS


def is_background(resname: Column) -> Column:
    """Protein, nucleic acid, water, lipid or ion."""
    name = F.upper(F.coalesce(resname, F.lit("")))
    return name.isin(*_BACKGROUND) | F.regexp_replace(name, "[-+0-9]+$", "").isin(*fv.IONS)


def is_stripped(resname: Column, keep_lipids: bool = False) -> Column:
    gone = fv.STRIP_WATER + fv.STRIP_IONS + ([] if keep_lipids else fv.STRIP_LIPIDS)
    return F.coalesce(resname, F.lit("")).isin(*gone)


def aa1(resname: Column) -> Column:
    """One-letter code, variants first; unknown residues and caps give ''."""
    letters = {**fv.CANONICAL_LETTERS, **fv.VARIANT_LETTERS}
    table = F.create_map(*[F.lit(x) for pair in letters.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(strip(resname))), F.lit(""))


def element_from_name(name: Column) -> Column:
    """Element by the first letter of an atom name, carbon if in doubt."""
    first = F.substring(strip(name), 1, 1)
    return F.when(first.isin("C", "N", "O", "S", "P", "H"), first).otherwise("C")


def atomic_number(symbol: Column) -> Column:
    """Atomic number of a symbol in any case; 0 if there is none."""
    known = F.array(*[F.lit(e) for e in fv.ELEMENTS])
    text = F.concat(F.upper(F.substring(symbol, 1, 1)), F.lower(F.substring(symbol, F.lit(2), F.length(symbol))))
    return F.coalesce(F.array_position(known, text), F.lit(0)).cast("int")


def infer_element(name: Column, element: Column) -> Column:
    """Atomic number of a topology atom whose element field may be wrong."""
    name, element = strip(F.coalesce(name, F.lit(""))), strip(F.coalesce(element, F.lit("")))
    lead = F.regexp_extract(name, r"^\p{L}+", 0)
    first = F.upper(F.substring(lead, 1, 1))
    by_field, two, one = atomic_number(element), atomic_number(F.substring(lead, 1, 2)), atomic_number(first)
    agrees = (element != "") & (name != "") & F.upper(name).startswith(F.upper(element))
    return (
        F.when(agrees & (by_field > 0), by_field)
        .when(first.isin(*fv.ORGANIC_LETTERS), one)
        .when((F.length(lead) >= 2) & (two > 0), two)
        .when(one > 0, one)
        .otherwise(by_field)
    )


def has_box(box: Column) -> Column:
    """Whether any box component differs from zero."""
    return F.coalesce(F.exists(box, lambda v: F.abs(v) >= 1e-6), F.lit(False))


# --- molecule names --------------------------------------------------------
def is_junk(name: Column) -> Column:
    """Whether a name is a registry code or too long to read."""
    n = strip(F.coalesce(name, F.lit("")))
    solid = ~n.contains(" ")
    code_like = (
        solid & n.rlike(r"\d") & n.rlike(r"\p{L}") & ((F.upper(n) == n) | (F.lower(n) == n))
    )
    return (
        (n == "")
        | n.rlike(fv.CAS_NUMBER)
        | n.rlike(fv.PDB_CODE)
        | n.rlike(fv.INCHIKEY)
        | n.contains(":")
        | (F.length(n) > 80)
        | (solid & (F.length(n) > 30))
        | code_like
    )


def inchi_layers(inchi: Column) -> Column:
    """Map of layer letter to layer text; a later layer with a letter wins."""
    parts = F.split(inchi, "/")
    tail = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))
    keyed = F.filter(
        F.transform(
            tail,
            lambda p: F.struct(
                F.when(p.rlike(r"^[+-]"), "p").when(p.rlike(r"^\p{L}"), F.substring(p, 1, 1)).alias("key"),
                p.alias("value"),
            ),
        ),
        lambda e: e["key"].isNotNull(),
    )
    head = F.array(F.struct(F.lit("raw").alias("key"), inchi.alias("value")))
    formula = F.when(
        F.size(parts) > 1, F.array(F.struct(F.lit("formula").alias("key"), F.get(parts, 1).alias("value")))
    ).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    # Duplicate keys are an error when a map is built, so earlier ones go first.
    last_only = F.filter(
        keyed, lambda e, i: ~F.exists(F.slice(keyed, i + 2, F.size(keyed)), lambda later: later["key"] == e["key"])
    )
    return F.when(inchi.isNotNull(), F.map_from_entries(F.concat(head, formula, last_only)))


def layer(layers: Column, key: str) -> Column:
    """One layer, '' if absent."""
    return F.coalesce(F.try_element_at(layers, F.lit(key)), F.lit(""))


def inchi_layer(inchi: Column, letter: str) -> Column:
    """One layer by its letter, the last if there are several, '' if absent; for few layers, where
    the map of ``inchi_layers`` costs more."""
    parts = F.split(inchi, "/")
    tail = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))
    return F.coalesce(F.try_element_at(F.filter(tail, lambda p: F.startswith(p, F.lit(letter))), F.lit(-1)), F.lit(""))


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
