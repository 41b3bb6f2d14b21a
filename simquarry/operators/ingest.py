"""Ingest: documents into relational tables by get-or-create.

Every operator works on all documents at once and returns the new table with
the actions that lead to it, so a caller with a table format that supports it
can run the same actions as a MERGE.  Keys are compared with ``=``: a NULL in a
key matches nothing and always makes a new row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StringType, StructField, StructType

from simquarry.functions import fixed_values as fv
from simquarry.functions import rules, text
from simquarry.functions.text import blank
from simquarry.operators.folding import Bearers, fold
from simquarry.operators.groups import connected
from simquarry.operators.intake import as_time
from simquarry.operators.ranking import number_rows
from simquarry.session import freeze

ORDER = ("doc", "pos")


class Upsert(NamedTuple):
    """New table, actions (action, id, values) and ids by group key."""

    table: DataFrame
    actions: DataFrame
    ids: DataFrame


def _max_id(table: DataFrame, id_col: str) -> int:
    return table.agg(F.max(id_col)).first()[0] or 0


def _group_key(keys: Sequence[str], order: Sequence[str]) -> Column:
    """Text that is equal for rows of one key; a row with a NULL in its key
    stands alone.  Lengths keep neighbouring values apart."""
    parts = [F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")) for k in keys]
    own = F.concat_ws("#", F.lit("row"), *[F.col(o).cast("string") for o in order])
    return F.coalesce(F.concat(*parts), own)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] = (),
    fill: Sequence[str] = (),
    first: Sequence[str] = (),
    order: Sequence[str] = ORDER,
    id_col: str = "id",
) -> Upsert:
    """Match by key, update or insert, ids in order of first appearance.

    ``update`` columns take the last incoming value, ``fill`` columns the last
    one that is not blank and else stay, ``first`` columns are written on
    insert only, from the first incoming row.
    """
    when = F.struct(*order)
    unknown = rules.any_of([F.col(k).isNull() for k in keys])
    # A row with a NULL in its key is a group of its own.  One struct a group
    # of columns keeps the number of aggregates small.
    grouped = freeze(
        source.withColumn("__alone", F.when(unknown, when))
        .groupBy(*keys, "__alone")
        .agg(
            F.min(when).alias("__first"),
            *([F.max(F.struct(when.alias("__w"), *update)).alias("__u")] if update else []),
            *([F.min(F.struct(when.alias("__w"), *first, *[F.col(c).alias(f"__raw_{c}") for c in fill])).alias("__f")]
              if [*first, *fill] else []),
            *[F.max_by(c, F.when(~blank(F.col(c)), when)).alias(c) for c in fill],
        )
        .select(
            _group_key(keys, [f"__first.{o}" for o in order]).alias("__key"), "__first", *keys,
            *[F.col(f"__u.{c}").alias(c) for c in update],
            *fill, *[F.col(f"__f.__raw_{c}").alias(f"__raw_{c}") for c in fill],
            *[F.col(f"__f.{c}").alias(c) for c in first],
        )
    )
    held = [*update, *fill]
    # Only target rows with an incoming key are grouped.  The incoming keys are
    # a written table of known size, so a small import is broadcast here and
    # the target is not shuffled.
    old = (
        target.join(grouped.select(*keys), list(keys), "left_semi")
        .groupBy(*keys)
        .agg(F.min(F.struct(id_col, *held)).alias("__old"))
        .select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__old")
    )
    same = None
    for k in keys:
        cond = F.col(k) == F.col(f"__k_{k}")
        same = cond if same is None else same & cond
    # Updates and inserts come from one evaluation of the source.
    matched = freeze(grouped.join(old, same, "left").drop(*[f"__k_{k}" for k in keys]))

    # Inserts, numbered after the greatest id.
    fresh = number_rows(matched.where(F.col("__old").isNull()), ["__first"], "__no")
    columns = [c for c in target.columns if c != id_col and c in {*keys, *held, *first}]
    inserts = fresh.select(
        "__key",
        (F.col("__no") + _max_id(target, id_col)).cast(target.schema[id_col].dataType).alias(id_col),
        *[
            (F.coalesce(c, f"__raw_{c}") if c in fill else F.col(c)).cast(target.schema[c].dataType).alias(c)
            for c in columns
        ],
    )

    # Updates that change something.
    hits = matched.where(F.col("__old").isNotNull())
    value = {c: F.coalesce(c, f"__old.{c}") if c in fill else F.col(c) for c in held}
    differs = F.lit(False)
    for c, v in value.items():
        differs = differs | ~v.eqNullSafe(F.col(f"__old.{c}"))
    updates = hits.where(differs).select(
        F.col(f"__old.{id_col}").alias(id_col),
        *[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys],
        *[v.cast(target.schema[c].dataType).alias(c) for c, v in value.items()],
    )

    table = target
    if held:
        new = updates.select(id_col, F.struct(*held).alias("__new"))
        table = target.join(new, id_col, "left").select(
            *[
                (F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) if c in held else F.col(c)).alias(c)
                for c in target.columns
            ]
        )
    table = table.unionByName(inserts.drop("__key"), allowMissingColumns=True)
    actions = updates.withColumn("action", F.lit("update")).unionByName(
        inserts.drop("__key").withColumn("action", F.lit("insert")), allowMissingColumns=True
    )
    ids = hits.select("__key", F.col(f"__old.{id_col}").alias(id_col)).unionByName(inserts.select("__key", id_col))
    return Upsert(table, actions, ids)


def with_ids(source: DataFrame, result: Upsert, keys: Sequence[str], name: str, order: Sequence[str] = ORDER) -> DataFrame:
    """The source rows with the id of the row each one found or made."""
    ids = result.ids.withColumnRenamed("id", name)
    return source.withColumn("__key", _group_key(keys, order)).join(ids, "__key").drop("__key")


# --- owners and simulations ------------------------------------------------
def resolve_owner(imports: DataFrame, account: DataFrame, user: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Owner id by the lead's ORCID, and the documents whose lead is unknown.

    The administrator's ORCID gives no owner.
    """
    owners = (
        account.where(F.col("provider") == "orcid")
        .join(user.select(F.col("id").alias("user_id")), "user_id", "left_semi")
        .groupBy(F.col("uid").alias("lead_contributor_orcid"))
        .agg(F.min("user_id").alias("owner_id"))
    )
    admin = F.col("lead_contributor_orcid") == fv.ADMIN_ORCID
    out = imports.join(owners, "lead_contributor_orcid", "left").withColumn(
        "owner_id", F.when(~admin, F.col("owner_id"))
    )
    known = F.coalesce(admin | F.col("owner_id").isNotNull(), F.lit(False))
    return out.where(known), out.where(~known).drop("owner_id")


class _Simulations:
    """Which simulation bears which alias and hash, as the documents of a component change it.

    A simulation is (0, id) if it was there and (1, document) if a document makes
    it, so that older ones come first.
    """

    def __init__(self, _component: str) -> None:
        self.alias: dict[tuple, str | None] = {}
        self.hash: dict[tuple, str | None] = {}
        self.by_alias = Bearers(lambda sim, value: self.alias[sim] == value)
        self.by_hash = Bearers(lambda sim, value: self.hash[sim] == value)

    def _write(self, sim: tuple, alias: str | None, hash_: str | None) -> None:
        self.alias[sim], self.hash[sim] = alias, hash_
        if alias is not None:
            self.by_alias.add(sim, alias)
        if hash_ is not None:
            self.by_hash.add(sim, hash_)

    def step(self, row: dict) -> list[dict]:
        doc, given, alias, hash_ = row["doc"], row["__sim"], row["__alias"], row["__hash"]
        if doc is None:
            self._write((0, given), alias, hash_)
            return []
        step, found = "id", None if given is None else (0, given)
        if found is None and alias is not None:
            step, found = "alias", self.by_alias.first(alias)
        if found is None and hash_ is not None:
            step, found = "hash", self.by_hash.first(hash_)
        if found is None:
            step, found = "new", (1, doc)
        self._write(found, alias, hash_)
        return [{"doc": doc, "step": step, "sim_id": None if found[0] else found[1], "made_by": found[1] if found[0] else None}]

    def finish(self) -> list[dict]:
        return []


def resolve_simulations(imports: DataFrame, sim: DataFrame) -> DataFrame:
    """Which simulation each document is about, and by which step it was found.

    ``imports`` has (doc, simulation_id, alias, owner_id, hash).  Steps: given
    id (``invalid`` if the table does not have it), alias and owner, file hash,
    new.  Of several simulations the oldest is taken.

    The result is that of applying the documents one after the other: each gives
    its simulation its own alias, owner and hash, which decide what later ones
    find.  Documents that share no key, directly or through others and through
    simulations, cannot meet; so they are folded component by component, in
    order, in as many tasks as there are partitions.  New simulations get ids
    after the greatest, in the order of the documents that make them.
    """
    # Members and keys are numbers, which are narrow to shuffle: two that meet by
    # chance only put more documents into one fold, which goes by the values.
    id_type = imports.schema["doc"].dataType
    number = F.col("doc").cast("long") if isinstance(id_type, IntegralType) else F.when(F.col("doc").isNotNull(), F.xxhash64("doc"))
    of_doc, of_sim = F.shiftleft(number, 1), lambda c: F.shiftleft(c, 1).bitwiseOR(F.lit(1))
    hashed = lambda kind, c: F.when(c.isNotNull(), F.xxhash64(F.lit(kind), c))
    named_alias = lambda owner, alias: F.when(~blank(alias), F.concat(owner.cast("string"), F.lit(":"), alias))
    given = F.coalesce("simulation_id", F.lit(0)) != 0
    known = sim.select(F.col("id").cast("long").alias("__sim"), F.lit(True).alias("__exists"))
    docs = imports.select(
        "doc", F.when(given, F.col("simulation_id")).cast("long").alias("__sim"),
        named_alias(F.col("owner_id"), F.col("alias")).alias("__alias"), F.col("hash").cast("string").alias("__hash"),
    )
    # Only documents that give an id go through the join on it.
    free, bound = docs.where("__sim is null"), docs.where("__sim is not null").join(known, "__sim", "left")
    valid = freeze(free.unionByName(bound.where("__exists").drop("__exists")).withColumn("member", of_doc))
    invalid = bound.where("__exists is null").select("doc")
    sims = sim.select(
        F.lit(None).cast(id_type).alias("doc"), F.col("id").cast("long").alias("__sim"),
        named_alias(F.col("created_by_id"), F.col("alias")).alias("__alias"),
        F.col("unique_file_hash_string").cast("string").alias("__hash"), of_sim(F.col("id").cast("long")).alias("member"),
    )
    keys = F.array_compact(F.array(of_sim(F.col("__sim")), hashed("a", F.col("__alias")), hashed("h", F.col("__hash"))))
    of_docs = valid.select("member", F.explode_outer(keys).alias("key"))
    # A simulation that one document may find ties all its keys together.
    hit = sims.select("member", F.explode(keys).alias("key")).join(of_docs.select("key").distinct(), "key", "left_semi").select("member").distinct()
    met = freeze(sims.join(hit, "member", "left_semi"))
    tied = connected(of_docs.unionByName(met.select("member", F.explode(keys).alias("key"))))
    told = StructType([StructField("doc", id_type), StructField("step", StringType()), StructField("sim_id", LongType()), StructField("made_by", id_type)])
    decided = freeze(fold(valid.unionByName(met).join(tied, "member"), "component", ["doc"], _Simulations, told))
    first = _max_id(sim, "id")
    made = number_rows(decided.where("step = 'new'").select("doc"), ["doc"], "__no").select(F.col("doc").alias("made_by"), (F.col("__no") + first).alias("__new"))
    # Documents of a simulation that was there have no maker and skip the join.
    ids = decided.where("made_by is null").select("doc", "step", "sim_id").unionByName(
        decided.where("made_by is not null").join(made, "made_by").select("doc", "step", F.col("__new").alias("sim_id"))
    )
    every = ids.unionByName(invalid.select("doc", F.lit("invalid").alias("step"), F.lit(None).cast("long").alias("sim_id")))
    return imports.join(every, "doc")


# Column of the simulation table: column of the document, value if absent.
_SIM_COLUMNS = {
    "unique_file_hash_string": ("hash", None),
    "alias": ("alias", None),
    "software_id": ("software_id", None),
    "created_by_id": ("owner_id", None),
    "run_commands": ("run_commands", None),
    "description": ("description", None),
    "short_description": ("short_description", None),
    "duration": ("duration", None),
    "sampling_frequency": ("sampling_frequency", None),
    "integration_timestep_fs": ("integration_timestep_fs", None),
    "water_type": ("water_type", ""),
    "water_density": ("water_density", None),
    "rmsd_values": ("rmsd_values", None),
    "rmsf_values": ("rmsf_values", None),
    "forcefield": ("forcefield", ""),
    "forcefield_comments": ("forcefield_comments", ""),
    "fasta_sequence": ("fasta_sequence", None),
    "num_replicates": ("num_replicates", None),
    "temperature": ("temperature_kelvin", None),
    "protonation_method": ("protonation_method", None),
    "is_embargoed": ("is_embargoed", False),
    "is_coarse_grained": ("is_coarse_grained", False),
}


def upsert_simulations(resolved: DataFrame, sim: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """The simulation table after all valid documents, and (doc, sim_id, action).

    A document writes every column, so the last one of a simulation is what
    stays.  An update makes the row a placeholder again and keeps ``is_public``.
    """
    todo = resolved.where(F.col("step") != "invalid")
    id_type = sim.schema["id"].dataType
    values = [
        (
            F.lit(default) if src not in resolved.columns else F.coalesce(src, F.lit(default)) if default is not None else F.col(src)
        ).cast(sim.schema[c].dataType).alias(c)
        for c, (src, default) in _SIM_COLUMNS.items()
        if c in sim.columns
    ]
    state = [F.lit(True).alias("is_placeholder"), F.lit(False).alias("is_deprecated")]
    last = freeze(
        todo.groupBy(F.col("sim_id").cast(id_type).alias("id"))
        .agg(F.max_by(F.struct(*values, *state), "doc").alias("__new"), F.max(F.col("step") == "new").alias("__made"))
    )
    written = last.select("__new.*").columns
    updated = sim.join(last.where(~F.col("__made")).drop("__made"), "id", "left").select(
        *[
            (F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) if c in written else F.col(c)).alias(c)
            for c in sim.columns
        ]
    )
    news = last.where("__made").select("id", "__new.*", F.lit(False).alias("is_public"), as_time(now).alias("creation_date"))
    added = news.select(*[c for c in news.columns if c in sim.columns])
    actions = todo.select("doc", F.col("sim_id").cast(id_type).alias("sim_id"), F.when(F.col("step") == "new", "insert").otherwise("update").alias("action"))
    return updated.unionByName(added, allowMissingColumns=True), actions


# --- tables below a simulation ---------------------------------------------
# Sources have (doc, pos, simulation_id) and the fields of the document.
def upsert_files(files: DataFrame, target: DataFrame, kind: str) -> Upsert:
    """Uploaded (``original``) or processed files by simulation and name."""
    name = text.basename(F.col("name")) if kind == "processed" else F.col("name")
    rows = files.select(
        *ORDER, "simulation_id", name.alias("filename"), "file_type", "description",
        text.permanent_path(F.col("simulation_id"), kind, F.col("name")).alias("local_file_path"),
        F.col("size").alias("file_size_bytes"), F.col("md5_sum").alias("md5_hash"),
        *([F.coalesce("is_primary", F.lit(False)).alias("is_primary")] if kind == "original" else []),
    )
    update = ["file_type", "description", "local_file_path", "file_size_bytes", "md5_hash"]
    return upsert(
        target, rows, ["simulation_id", "filename"], update + (["is_primary"] if kind == "original" else [])
    )


def upsert_software(imports: DataFrame, target: DataFrame) -> Upsert:
    """Software by name and version; an unknown version always is a new row."""
    return upsert(target, imports, ["name", "version"])


def upsert_pdb(pdbs: DataFrame, target: DataFrame, sim: DataFrame) -> tuple[Upsert, DataFrame]:
    """PDB entries by lower-case id, and the simulations that refer to them."""
    rows = pdbs.withColumn("pdb_id", F.lower("pdb_id"))
    done = upsert(target, rows, ["pdb_id"], ["title", "classification"])
    refs = (
        with_ids(rows, done, ["pdb_id"], "__pdb")
        .groupBy(F.col("simulation_id").alias("id"))
        .agg(F.max_by("__pdb", F.struct(*ORDER)).alias("__pdb"))
    )
    return done, sim.join(refs, "id", "left").withColumn("pdb_id", F.coalesce("__pdb", "pdb_id")).drop("__pdb")


def upsert_uniprot(uniprots: DataFrame, target: DataFrame, links: DataFrame) -> tuple[Upsert, Upsert]:
    """UniProt entries by accession, and links to simulations if absent."""
    rows = uniprots.withColumn("amino_length", F.length("sequence"))
    done = upsert(target, rows, ["uniprot_id"], ["name", "amino_length", "sequence"])
    pairs = with_ids(rows, done, ["uniprot_id"], "__pk").select(
        *ORDER, "simulation_id", F.col("__pk").alias("uniprot_id")
    )
    return done, upsert(links, pairs, ["uniprot_id", "simulation_id"])


def upsert_ligands(ligands: DataFrame, target: DataFrame) -> Upsert:
    rows = ligands.withColumnRenamed("smiles", "smiles_string")
    return upsert(target, rows, ["simulation_id", "name"], ["smiles_string"])


def upsert_links(links: DataFrame, target: DataFrame) -> Upsert:
    """External links by address; a label is replaced only by a given one."""
    return upsert(target, links, ["simulation_id", "url"], fill=["label"])


def upsert_solutes(solutes: DataFrame, target: DataFrame, rename: dict[str, str] | None = None) -> Upsert:
    """Solutes by simulation and renamed name."""
    rename = fv.SOLUTE_NAMES if rename is None else rename
    name = F.col("name")
    if rename:
        table = F.create_map(*[F.lit(x) for pair in rename.items() for x in pair])
        name = F.coalesce(F.try_element_at(table, name), name)
    rows = solutes.withColumn("name", name).withColumnRenamed("concentration_mol_liter", "concentration")
    return upsert(target, rows, ["simulation_id", "name"], ["concentration"])


def upsert_replicates(replicates: DataFrame, target: DataFrame) -> Upsert:
    return upsert(target, replicates, ["simulation_id", "trajectory_file_name"])


_PAPER = ["title", "authors", "journal", "volume", "year"]


def upsert_papers(papers: DataFrame, target: DataFrame, links: DataFrame) -> tuple[Upsert, Upsert]:
    """Publications by DOI, else by five fields, and links to simulations.

    A paper without DOI may find an existing row that has one, and also one
    that an earlier paper of the same batch adds.
    """
    when = F.struct(*ORDER)
    has_doi = ~blank(F.col("doi"))
    fields = _group_key(_PAPER, ORDER)
    rows = papers.withColumn(
        "__key", F.when(has_doi, F.concat(F.lit("doi:"), F.col("doi"))).otherwise(F.concat(F.lit("fields:"), fields))
    )
    groups = rows.groupBy("__key").agg(
        F.min(when).alias("__first"), F.min_by(F.struct(*_PAPER, "doi"), when).alias("v")
    ).select("__key", "__first", "v.*")
    by_doi = target.groupBy("doi").agg(F.min("id").alias("__id"))
    by_fields = target.groupBy(*_PAPER).agg(F.min("id").alias("__id"))
    with_doi = groups.where(has_doi).join(by_doi, "doi", "left").select(*groups.columns, "__id")
    without = groups.where(~has_doi).join(by_fields, _PAPER, "left").select(*groups.columns, "__id")
    # Rows the batch itself adds under a DOI, by their five fields.
    added = (
        with_doi.where("__id is null")
        .groupBy(*_PAPER)
        .agg(F.min(F.struct("__first", "__key")).alias("__doi"))
    )
    without = without.join(added, _PAPER, "left").select(
        *groups.columns, "__id",
        F.when(F.col("__id").isNull() & (F.col("__doi.__first") < F.col("__first")), F.col("__doi.__key")).alias("__via"),
    )
    # Numbers, ids and links all start from this one set.
    every = freeze(with_doi.withColumn("__via", F.lit(None).cast("string")).unionByName(without))
    fresh = number_rows(every.where("__id is null and __via is null"), ["__first"], "__no").withColumn(
        "id", (F.col("__no") + _max_id(target, "id")).cast(target.schema["id"].dataType)
    )
    inserts = fresh.select("id", *_PAPER, "doi")
    table = target.unionByName(inserts, allowMissingColumns=True)
    direct = every.where("__id is not null").select("__key", F.col("__id").alias("id")).unionByName(
        fresh.select("__key", "id")
    )
    borrowed = every.where("__via is not null").select("__key", "__via").join(
        fresh.select(F.col("__key").alias("__via"), "id"), "__via"
    ).select("__key", "id")
    ids = direct.unionByName(borrowed)
    pairs = rows.join(ids, "__key").select(*ORDER, "simulation_id", F.col("id").alias("pub_id"))
    done = Upsert(table, inserts.withColumn("action", F.lit("insert")), ids)
    return done, upsert(links, pairs, ["pub_id", "simulation_id"])


# --- contributors ----------------------------------------------------------
_PERSON = ["name", "email", "institution", "orcid", "rank"]


class _People:
    """The contributors of one simulation, as those of its documents come in."""

    KEYS = ("orcid", "email", "name")

    def __init__(self, _simulation: int) -> None:
        self.rows: list[dict] = []
        self.by = {f: Bearers(lambda at, value, f=f: self.rows[at][f] == value) for f in self.KEYS}

    def _index(self, at: int) -> None:
        for f in self.KEYS:
            if self.rows[at][f]:
                self.by[f].add(at, self.rows[at][f])

    def step(self, row: dict) -> list[dict]:
        at = None
        if row["doc"] is not None:
            field = next(f for f in self.KEYS if row[f])
            at = self.by[field].first(row[field])
        if at is None:
            at = len(self.rows)
            self.rows.append({**row, "touched": row["doc"] is not None})
        else:
            self.rows[at] |= {f: row[f] for f in _PERSON} | {"touched": True}
        self._index(at)
        return []

    def finish(self) -> list[dict]:
        return [row for row in self.rows if row["touched"]]


def upsert_contributors(docs: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New table, actions and rejected contributors.

    ``docs`` has (doc, simulation_id, contributors), the last being the array
    of structs (name, email, institution, orcid, rank) of the document.  The
    key is ORCID, else e-mail, else name, and a contributor may change what a
    later one finds, of the same document or of the next one of its simulation.
    So they are folded in order, simulation by simulation; what a task holds is
    the people of one simulation.
    """
    text_or_empty = lambda c: F.coalesce(c, F.lit("")).alias
    people = F.transform(
        F.col("contributors"),
        lambda p, i: F.struct(
            i.cast("long").alias("pos"),
            *[text_or_empty(p[f])(f) for f in ("name", "email", "institution", "orcid")],
            F.coalesce(p["rank"], i + 1).cast("int").alias("rank"),
        ),
    )
    incoming = docs.select("doc", "simulation_id", F.inline(people)).withColumn("id", F.lit(None).cast("long"))
    named = (F.col("orcid") != "") | (F.col("email") != "") | (F.col("name") != "")
    rejects = incoming.where(~named).drop("id")
    held = target.join(docs.select("simulation_id"), "simulation_id", "left_semi").select(
        F.lit(None).cast(docs.schema["doc"].dataType).alias("doc"), "simulation_id", F.lit(None).cast("long").alias("pos"),
        *_PERSON[:-1], F.col("rank").cast("int").alias("rank"), F.col("id").cast("long").alias("id"),
    )
    rows = incoming.where(named).unionByName(held)
    done = freeze(fold(rows, "simulation_id", ["doc", "pos", "id"], _People, rows.schema))
    updates = done.where("id is not null").select("id", "simulation_id", *_PERSON)
    start = _max_id(target, "id")
    inserts = number_rows(done.where("id is null"), ORDER, "__no").select(
        (F.col("__no") + start).alias("id"), "simulation_id", *_PERSON
    )
    new = updates.select("id", F.struct(*_PERSON).alias("__new"))
    both = target.join(new, "id", "left")
    table = both.select(
        *[
            (F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) if c in _PERSON else F.col(c)).alias(c)
            for c in target.columns
        ]
    ).unionByName(inserts, allowMissingColumns=True)
    differs = F.lit(False)
    for c in _PERSON:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__new.{c}"))
    changed = both.where(F.col("__new").isNotNull() & differs).select(
        "id", "simulation_id", "__new.*", F.lit("update").alias("action")
    )
    actions = changed.unionByName(inserts.withColumn("action", F.lit("insert")))
    return table, actions, rejects


# --- reprocessing ----------------------------------------------------------
def clear_for_reprocess(
    sims: DataFrame,
    processed: DataFrame,
    processed_downloads: DataFrame,
    uploaded: DataFrame | None = None,
    uploaded_downloads: DataFrame | None = None,
) -> list[DataFrame]:
    """File and download-link tables without the rows of these simulations.

    Uploaded files are cleared only if their tables are passed.
    """
    chosen = sims.select("simulation_id").distinct()

    def cleared(files: DataFrame, downloads: DataFrame, ref: str) -> list[DataFrame]:
        gone = files.join(chosen, "simulation_id", "left_semi").select(F.col("id").alias(ref))
        return [files.join(chosen, "simulation_id", "left_anti"), downloads.join(gone, ref, "left_anti")]

    out = cleared(processed, processed_downloads, "simulationprocessedfile_id")
    if uploaded is not None:
        out += cleared(uploaded, uploaded_downloads, "simulationuploadedfile_id")
    return out


# --- whole documents -------------------------------------------------------
def ingest_documents(
    docs: DataFrame, tables: dict[str, DataFrame], now
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """All tables after the import, (doc, sim_id, action) of each document applied, and rejects (doc, reason).

    ``docs`` are parsed import documents, ``tables`` the tables by name.  Every
    document that is not rejected is applied, with all its parts, as if one came
    after the other.  One with an unknown lead, an id that does not exist or a
    contributor without name, address and ORCID is not applied at all.  Nothing
    is written here, so the caller replaces the tables once everything has
    succeeded.
    """
    # Documents are read here, not at the top, to keep operators below sources.
    from simquarry.sources.documents import elements

    out = dict(tables)
    known, unknown = resolve_owner(docs, tables["account"], tables["user"])
    nobody = lambda p: blank(p["orcid"]) & blank(p["email"]) & blank(p["name"])
    nameless = F.exists(F.coalesce("contributors", F.array().cast(docs.schema["contributors"].dataType)), nobody)
    resolved = resolve_simulations(known.where(~nameless), tables["simulation"])
    todo = freeze(resolved.where(F.col("step") != "invalid"))
    software = upsert_software(
        todo.select("doc", F.lit(0).alias("pos"), F.col("software_name").alias("name"), F.col("software_version").alias("version")),
        tables["software"],
    )
    out["software"] = software.table
    with_software = with_ids(
        todo.withColumns({"pos": F.lit(0), "name": F.col("software_name"), "version": F.col("software_version")}),
        software, ["name", "version"], "software_id",
    ).drop("pos", "name", "version")
    table, actions = upsert_simulations(with_software, tables["simulation"], now)
    part = lambda field, **k: elements(todo, field, **k)
    out["uploaded_file"] = upsert_files(part("original_files"), tables["uploaded_file"], "original").table
    out["processed_file"] = upsert_files(part("processed_files"), tables["processed_file"], "processed").table
    out["replicate"] = upsert_replicates(
        part("replicates").withColumnRenamed("e", "trajectory_file_name"), tables["replicate"]
    ).table
    people = todo.where(F.col("contributors").isNotNull()).select(
        "doc", F.col("sim_id").alias("simulation_id"), "contributors"
    )
    out["contribution"] = upsert_contributors(people, tables["contribution"])[0]
    out["ligand"] = upsert_ligands(part("ligands"), tables["ligand"]).table
    out["solute"] = upsert_solutes(part("solutes"), tables["solute"]).table
    out["external_link"] = upsert_links(part("external_links"), tables["external_link"]).table
    pubs, pub_links = upsert_papers(part("papers"), tables["pub"], tables["simulation_pub"])
    out["pub"], out["simulation_pub"] = pubs.table, pub_links.table
    proteins, protein_links = upsert_uniprot(part("uniprots"), tables["uniprot"], tables["simulation_uniprot"])
    out["uniprot"], out["simulation_uniprot"] = proteins.table, protein_links.table
    pdb, out["simulation"] = upsert_pdb(part("pdb", single=True), tables["pdb"], table)
    out["pdb"] = pdb.table
    rejects = (
        unknown.select("doc", F.lit("unknown lead contributor").alias("reason"))
        .unionByName(resolved.where("step = 'invalid'").select("doc", F.lit("no such simulation").alias("reason")))
        .unionByName(known.where(nameless).select("doc", F.lit("contributor without a name").alias("reason")))
    )
    return out, actions, rejects
