"""Molecule identity and naming over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import rules
from simquarry.functions.rules import layer
from simquarry.functions.text import strip

_STEREO = ["c", "t", "b", "m"]


def compare_molecules(pairs: DataFrame) -> DataFrame:
    """Compare (canonical1, inchi1) with (canonical2, inchi2) at four levels.

    A molecule without a connectivity layer matches nothing on that level.
    """
    p = pairs.withColumns(
        {"__a": rules.inchi_layers(F.col("inchi1")), "__b": rules.inchi_layers(F.col("inchi2"))}
    )
    a, b = F.col("__a"), F.col("__b")
    same = lambda key: layer(a, key) == layer(b, key)
    connected = same("c") & (layer(a, "c") != "")
    raw = lambda m, key: F.try_element_at(m, F.lit(key))
    shown = lambda m: F.coalesce(raw(m, "formula"), F.lit("None"))
    differs = lambda key: ~raw(a, key).eqNullSafe(raw(b, key))
    notes = F.array_compact(
        F.array(
            F.when(differs("formula"), F.concat(F.lit("formula ("), shown(a), F.lit(" vs "), shown(b), F.lit(")"))),
            F.when(differs("h"), "hydrogen attachment"),
            F.when(~same("q"), "charge"),
            F.when(~same("p"), "protonation"),
            F.when(~same("t"), "tetrahedral stereo"),
            F.when(~same("b"), "E/Z stereo"),
        )
    )
    stereo = connected
    for key in _STEREO:
        stereo = stereo & same(key)
    return p.withColumns(
        {
            "exact_match": F.col("canonical1") == F.col("canonical2"),
            "same_connectivity": connected,
            "same_connectivity_and_stereo": stereo,
            "same_inchi": F.col("inchi1") == F.col("inchi2"),
            "differences": F.when(connected, notes).otherwise(F.array(F.lit("connectivity (different molecules)"))),
            "connectivity_layer": F.when(connected, layer(a, "c")),
        }
    ).drop("__a", "__b")


def level_key(canonical: Column, inchi: Column, level: str) -> Column:
    """Text that is equal for molecules that match at a level; NULL if the
    molecule matches nothing there."""
    conn = F.nullif(rules.inchi_layer(inchi, "c"), F.lit(""))
    if level == "exact":
        return canonical
    if level == "inchi":
        return inchi
    if level == "connectivity":
        return conn
    if level == "stereo":
        return F.when(conn.isNotNull(), F.concat_ws("/", *[rules.inchi_layer(inchi, k) for k in _STEREO]))
    raise ValueError(f"unknown level {level!r}")


def identity_groups(mols: DataFrame, level: str) -> DataFrame:
    """Group of each molecule at a level: least id of the group and its size.

    A group is an aggregate joined back on its key, so molecules are never
    paired; a hot key is split by AQE.  A molecule without a key is alone.
    """
    keyed = mols.withColumn("__key", level_key(F.col("canonical"), F.col("inchi"), level))
    groups = (
        keyed.where("__key is not null")
        .groupBy("__key")
        .agg(F.min("mol_id").alias("__id"), F.count(F.lit(1)).alias("__n"))
    )
    return (
        keyed.join(groups, "__key", "left")
        .withColumn("group_id", F.coalesce("__id", "mol_id"))
        .withColumn("group_size", F.coalesce("__n", F.lit(1)))
        .drop("__key", "__id", "__n")
    )


def lookup_names(
    mols: DataFrame, labels: DataFrame, titles: DataFrame, xrefs: DataFrame, compounds: DataFrame
) -> DataFrame:
    """Label, title and compound name of each molecule by its InChIKey.

    ``labels`` and ``titles`` have (inchikey, label / title), ``xrefs``
    (inchikey, src_id, src_compound_id), ``compounds`` (compound_id, name).  A
    label that is only an entry number counts as none; of several values the
    least is taken.
    """
    label = strip(F.col("label"))
    lab = (
        labels.where((label != "") & ~label.rlike(fv.LABEL_IS_ID))
        .groupBy("inchikey").agg(F.min(label).alias("label"))
    )
    tit = titles.groupBy("inchikey").agg(F.min("title").alias("title"))
    ref = (
        xrefs.where(F.col("src_id") == fv.PDB_COMPOUND_SOURCE)
        .groupBy("inchikey").agg(F.min("src_compound_id").alias("compound_id"))
    )
    name = strip(F.col("name"))
    com = compounds.where(name != "").groupBy("compound_id").agg(F.min(name).alias("compound_name"))
    return (
        mols.join(lab, "inchikey", "left")
        .join(tit, "inchikey", "left")
        .join(ref.join(com, "compound_id", "left").drop("compound_id"), "inchikey", "left")
    )


def best_synonym(synonyms: DataFrame, keep: int = 10) -> DataFrame:
    """Per molecule the first synonym that is not junk, and the first few as
    evidence, from (mol_id, pos, synonym).

    The evidence is cut by position before it is collected, so its size is
    bounded whatever the number of synonyms.
    """
    good = ~rules.is_junk(F.col("synonym"))
    return synonyms.groupBy("mol_id").agg(
        F.min_by("synonym", F.when(good, F.col("pos"))).alias("synonym"),
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("pos") < keep, F.struct("pos", "synonym")))),
            lambda e: e["synonym"],
        ).alias("evidence"),
    )


def best_names(mols: DataFrame) -> DataFrame:
    """Display name and its source from label, synonym, compound name, title.

    A readable label goes first, a code-like one only after the synonyms.
    """
    usable = F.col("label").isNotNull() & ~rules.is_junk(F.col("label"))
    readable = usable & F.col("label").rlike(r"\p{Ll}")
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""

    def first_of(source: bool) -> Column:
        pick = lambda name, col: F.lit(name) if source else F.col(col)
        return (
            F.when(readable, pick("wikidata", "label"))
            .when(given("synonym"), pick("pubchem_synonyms", "synonym"))
            .when(usable, pick("wikidata", "label"))
            .when(given("compound_name"), pick("pdbe", "compound_name"))
            .when(given("title"), pick("pubchem_title", "title"))
        )

    return mols.withColumns(
        {"best_name": F.coalesce(first_of(False), F.lit("unknown")), "name_source": first_of(True)}
    )


def checked_batch(df: DataFrame, batch: str, pos: str, value: str, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of batches without a bad value, and per bad batch its first one.

    One bad value fails its whole batch.
    """
    bad = (
        df.where(~F.coalesce(valid, F.lit(False)))
        .groupBy(batch)
        .agg(F.min_by(value, pos).alias("offender"), F.min(pos).alias("at"))
    )
    return df.join(bad.select(batch), batch, "left_anti"), bad
