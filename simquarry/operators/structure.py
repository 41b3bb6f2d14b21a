"""Atoms and residues: ligand candidates, sequences, chains, matching files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import rules, text
from simquarry.session import broadcast_if_small

# Residues of one chain are joined to text in pieces of this span of positions.
_PIECE = 4096


# --- residues --------------------------------------------------------------
def ligand_resnames(atoms: DataFrame) -> DataFrame:
    """Atom counts of the residue names that are not background."""
    return (
        atoms.groupBy("sim_id", "resname")
        .agg(F.count(F.lit(1)).alias("n_atoms"))
        .where(~rules.is_background(F.col("resname")))
    )


def target_resnames(atoms: DataFrame, wanted: DataFrame) -> DataFrame:
    """Residue names to extract per structure, or the reason there are none.

    ``wanted`` has one row (sim_id, wanted) per structure, wanted possibly
    NULL.  A name that is present is taken alone, else every candidate.
    """
    names = atoms.select("sim_id", "resname").distinct()
    present = names.select("sim_id", F.col("resname").alias("wanted"), F.lit(True).alias("__hit"))
    state = wanted.join(present, ["sim_id", "wanted"], "left")
    direct = state.where("__hit").select("sim_id", F.col("wanted").alias("resname"), F.lit(None).cast("string").alias("error"))
    rest = (
        state.where("__hit is null")
        .join(names.where(~rules.is_background(F.col("resname"))), "sim_id", "left")
        .select(
            "sim_id", "resname",
            F.when(F.col("resname").isNull() & F.col("wanted").isNotNull(), "name absent and no candidate")
            .when(F.col("resname").isNull(), "no candidate")
            .alias("error"),
        )
    )
    return direct.unionByName(rest)


def first_residue(atoms: DataFrame, targets: DataFrame) -> DataFrame:
    """Atoms of the first instance of each target residue.

    ``targets`` has (sim_id, target).  The exact name goes before a name that
    differs in case only.
    """
    t = targets.withColumn("__u", F.upper("target"))
    a = atoms.withColumn("__u", F.upper("resname"))
    exact = F.col("resname") == F.col("target")
    firsts = (
        a.join(t, ["sim_id", "__u"])
        .groupBy("sim_id", "target", "__u")
        .agg(F.min(F.when(exact, F.col("resix"))).alias("__e"), F.min("resix").alias("__any"))
        .select("sim_id", "target", "__u", F.col("__e").isNotNull().alias("__exact"), F.coalesce("__e", "__any").alias("resix"))
    )
    return (
        a.join(firsts, ["sim_id", "__u", "resix"])
        .where(~F.col("__exact") | exact)
        .select("target", *atoms.columns)
    )


def system_flags(atoms: DataFrame) -> DataFrame:
    """Lipids present, protein backbone present."""
    return atoms.groupBy("sim_id").agg(
        F.bool_or(F.coalesce(F.col("resname").isin(*fv.STRIP_LIPIDS), F.lit(False))).alias("has_lipid"),
        F.bool_or(F.coalesce(F.col("name").isin(*fv.BACKBONE), F.lit(False))).alias("has_backbone"),
    )


def select_atoms(atoms: DataFrame, names: Sequence[str] = tuple(fv.BACKBONE)) -> DataFrame:
    """The named atoms of each structure, or all of them where it has none."""
    wanted = F.coalesce(F.col("name").isin(*names), F.lit(False))
    flags = atoms.groupBy("sim_id").agg(F.bool_or(wanted).alias("__has"))
    return atoms.join(flags, "sim_id").where(wanted | ~F.col("__has")).drop("__has")


def fix_elements(atoms: DataFrame) -> DataFrame:
    """Replace an unknown element (``??``) by one inferred from the name."""
    return atoms.withColumn(
        "element",
        F.when(F.col("element") == "??", rules.element_from_name(F.col("name"))).otherwise(F.col("element")),
    )


# --- atom counts -----------------------------------------------------------
def _atom_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("sim_id").agg(F.count_distinct("atom_id").alias(name))


def prestripped(traj: DataFrame, top: DataFrame) -> DataFrame:
    """Whether a trajectory has fewer atoms than its topology."""
    both = _atom_counts(top, "top_atoms").join(_atom_counts(traj, "traj_atoms"), "sim_id")
    return both.withColumn("prestripped", F.col("traj_atoms") < F.col("top_atoms"))


def natoms_mismatch(coords: DataFrame, top: DataFrame) -> DataFrame:
    """Structures whose coordinate file has another number of atoms."""
    both = _atom_counts(top, "top_atoms").join(_atom_counts(coords, "coord_atoms"), "sim_id")
    return both.where(F.col("coord_atoms") != F.col("top_atoms"))


# --- sequences and chains --------------------------------------------------
def chain_sequences(atoms: DataFrame, first_model_only: bool = False) -> DataFrame:
    """One-letter sequence per chain, or an error row for a structure without.

    ``atoms`` has (sim_id, chain, resname, residue, line_no) and optionally
    ``model`` and ``record``; ``residue`` tells residues of a chain apart.
    Chains are numbered in file order; one of only unknown residues is dropped
    but keeps its number.  Pieces of a chain are joined first, so that no task
    collects a whole chain residue by residue.
    """
    a = atoms if "model" in atoms.columns else atoms.withColumn("model", F.lit(1))
    if first_model_only:
        a = a.where(F.col("model") == 1)
    chain = F.when(F.coalesce(text.strip(F.col("chain")), F.lit("")) == "", "_").otherwise(text.strip(F.col("chain")))
    standard = F.col("record") == "ATOM" if "record" in atoms.columns else F.lit(True)
    residues = (
        a.withColumn("chain", chain)
        .groupBy("sim_id", "model", "chain", "residue", "resname")
        .agg(F.min("line_no").alias("first_line"), F.min(F.when(standard, F.col("line_no"))).alias("pos"))
        .withColumn("aa", F.when(F.col("pos").isNotNull(), rules.aa1(F.col("resname"))).otherwise(""))
    )
    used = F.col("aa") != ""
    # Place of a chain: the first model that gives it a letter, then the first
    # line of the chain there.
    places = (
        residues.groupBy("sim_id", "model", "chain")
        .agg(F.min("first_line").alias("line"), F.bool_or(used).alias("__used"))
        .where("__used")
        .groupBy("sim_id", "chain")
        .agg(F.min(F.struct("model", "line")).alias("place"))
    )
    # One row per chain by now, so the window sees a handful of rows.
    numbered = places.withColumn("number", F.row_number().over(Window.partitionBy("sim_id").orderBy("place")))

    def joined(order: list[str], col: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct(*order, col)))
        return F.array_join(F.transform(rows, lambda r: r[col]), "")

    pieces = (
        residues.where(used)
        .withColumn("piece", F.floor(F.col("pos") / _PIECE))
        .groupBy("sim_id", "chain", "model", "piece")
        .agg(joined(["pos"], "aa").alias("part"))
    )
    whole = pieces.groupBy("sim_id", "chain").agg(joined(["model", "piece"], "part").alias("sequence"))
    named = numbered.select("sim_id", "chain", "number").join(whole, ["sim_id", "chain"])
    lost = atoms.select("sim_id").distinct().join(named.select("sim_id"), "sim_id", "left_anti")
    return (
        named.where(~F.col("sequence").rlike("^X+$"))
        .withColumn("error", F.lit(None).cast("string"))
        .unionByName(lost.withColumn("error", F.lit("no sequence")), allowMissingColumns=True)
    )


def restore_chains(target: DataFrame, ref: DataFrame) -> DataFrame:
    """Chain ids of a reference structure by residue number.

    The last atom line of a residue decides, blank chains are ignored, and
    atoms without a match keep their chain.
    """
    chain = text.strip(F.col("chain"))
    known = (
        ref.where((chain != "") & F.col("resnum").isNotNull())
        .groupBy("sim_id", "resnum")
        .agg(F.max_by(chain, "line_no").alias("__chain"))
    )
    return target.join(known, ["sim_id", "resnum"], "left").withColumn("chain", F.coalesce("__chain", "chain")).drop("__chain")


# --- stripping -------------------------------------------------------------
def kept_atoms(atoms: DataFrame, keep_lipids: bool = False) -> DataFrame:
    """Atoms without water and ions and, unless kept, lipids.

    With ``keep_lipids`` only structures that have lipids are in the result.
    """
    out = atoms.where(~rules.is_stripped(F.col("resname"), keep_lipids))
    if not keep_lipids:
        return out
    with_lipid = system_flags(atoms).where("has_lipid").select("sim_id")
    return out.join(with_lipid, "sim_id", "left_semi")


def strip(atoms: DataFrame, coords: DataFrame, keep_lipids: bool = False) -> tuple[DataFrame, DataFrame]:
    """Kept atoms and their coordinates.

    Coordinates dwarf the atoms; a short list of kept atoms is broadcast, so
    that the coordinates are filtered in place.
    """
    kept = kept_atoms(atoms, keep_lipids)
    return kept, coords.join(broadcast_if_small(kept.select("sim_id", "atom_id")), ["sim_id", "atom_id"], "left_semi")


# --- files -----------------------------------------------------------------
def software_extensions(spark: SparkSession) -> DataFrame:
    """Fixed table of software and expected extensions."""
    rows = [(s, e) for s, exts in fv.SOFTWARE_EXTENSIONS.items() for e in exts]
    return spark.createDataFrame(rows, "software string, extension string")


def expected_extensions(sims: DataFrame) -> DataFrame:
    """Simulations (simulation_id, software) with each extension expected."""
    table = F.create_map(
        *[x for s, exts in fv.SOFTWARE_EXTENSIONS.items() for x in (F.lit(s), F.array(*[F.lit(e) for e in exts]))]
    )
    return sims.withColumn("extension", F.explode(F.try_element_at(table, F.lower("software"))))


def missing_exts(sims: DataFrame, files: DataFrame) -> DataFrame:
    """Simulations of known software that have none of its extensions."""
    expected = expected_extensions(sims)
    have = files.select("simulation_id", text.extension(F.col("filename")).alias("extension"))
    met = expected.join(have, ["simulation_id", "extension"], "left_semi").select("simulation_id")
    return (
        sims.where(F.lower("software").isin(*fv.SOFTWARE_EXTENSIONS))
        .join(met, "simulation_id", "left_anti")
    )


def match_sibling(files: DataFrame, base_ext: str, ext: str, mode: str = "exact") -> DataFrame:
    """For each file with ``base_ext`` its partner with ``ext`` in the folder.

    The same stem goes first; with mode ``prefix`` then the least candidate
    whose stem begins the other or is begun by it; then the only candidate.
    Prefixes are written out and joined by equality, so the files of a large
    folder are never paired with one another.
    """
    f = files.select("path", text.dirname(F.col("path")).alias("dir"), text.stem(F.col("path")).alias("stem"))
    base = f.where(F.col("path").endswith(base_ext)).distinct()
    cand = f.where(F.col("path").endswith(ext)).distinct().withColumnRenamed("path", "found")
    same = cand.groupBy("dir", "stem").agg(F.min("found").alias("__exact"))
    only = (
        cand.groupBy("dir").agg(F.count(F.lit(1)).alias("n"), F.min("found").alias("__only")).where("n = 1").drop("n")
    )
    out = base.join(same, ["dir", "stem"], "left").join(only, "dir", "left")
    choice = [F.col("__exact")]
    if mode == "prefix":
        prefixes = F.explode(
            F.transform(F.sequence(F.lit(1), F.length("stem")), lambda n: F.substring(F.col("stem"), F.lit(1), n))
        )
        begun = cand.select("dir", prefixes.alias("stem"), "found").groupBy("dir", "stem").agg(F.min("found").alias("__long"))
        begins = (
            base.select("path", "dir", prefixes.alias("p"))
            .join(same.withColumnRenamed("stem", "p"), ["dir", "p"])
            .groupBy("path")
            .agg(F.min("__exact").alias("__short"))
        )
        out = out.join(begun, ["dir", "stem"], "left").join(begins, "path", "left")
        choice.append(F.least("__long", "__short"))
    return out.select("path", F.coalesce(*choice, "__only").alias("match"))


def time_axis(logs: DataFrame) -> DataFrame:
    """Whether the reader reported a time axis, per run of (run_id, line_no,
    line); NULL if it said nothing that can be read."""
    line = F.col("line")
    told = line.contains(" is a ") & line.contains(" with ")
    contents = F.substring_index(F.substring(line, F.locate(" with ", line) + 6, F.length(line)), " Parm ", 1)
    fields = F.transform(F.split(F.translate(contents, ".", ","), ","), text.strip)
    return logs.groupBy("run_id").agg(
        F.min_by(F.array_contains(fields, "time"), F.when(told, F.col("line_no"))).alias("has_time")
    )
