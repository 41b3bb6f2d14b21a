"""Queries on atoms, frames, files of a directory and molecules."""

from __future__ import annotations

from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import rules, text
from simquarry.operators import molecules as mol
from simquarry.operators import structure as op
from simquarry.operators import trajectory as tr
from simquarry.plans.registry import Inputs, named
from simquarry.plans.views import query


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


BACKGROUND = (
    f"(upper(resname) in ({quoted(fv.AMINO_ACIDS + fv.NUCLEOTIDES + fv.WATERS + fv.LIPIDS)}) "
    f"or regexp_replace(upper(resname), '[-+0-9]+$', '') in ({quoted(fv.IONS)}))"
)
LETTERS = {**fv.CANONICAL_LETTERS, **fv.VARIANT_LETTERS}


# --- scalar rules ----------------------------------------------------------
@named(
    "p14_format_by_ext",
    r"""select page_id, case when e in ('.prmtop', '.parm7') or f in ('.prmtop', '.parm7') then 'amber' when e = '.psf' or f = '.psf' then 'namd'
          when e in ('.rtf', '.prm') or f in ('.rtf', '.prm') then 'charmm' when e in ('.top', '.tpr', '.gro') or f in ('.top', '.tpr', '.gro') then 'gromacs' end as format
        from (select page_id, concat('.', lower(split_part(path, '.', 2))) as e, case page_id % 7 when 0 then '.parm7' when 1 then '.prm' when 2 then '.x' end as f
              from v_dir_files)""",
)
def _(i: Inputs):
    second = F.when(F.col("page_id") % 7 == 0, "/q/a.PARM7").when(F.col("page_id") % 7 == 1, "b.prm").when(F.col("page_id") % 7 == 2, "c.x")
    return i.v_dir_files.select("page_id", rules.format_by_ext(F.array("path", second)).alias("format"))


# File heads of every kind, in ASCII, so that bytes and characters agree.
HEADS = """
select p_partkey, concat('/d/', p_partkey, case p_partkey % 3 when 0 then '.tpr' when 1 then '.xyz' else '.PRMTOP' end) as path,
       case p_partkey % 8 when 0 then concat('REMARK x', chr(10), p_name) when 1 then concat('; ', p_name, chr(10), ' [ moleculetype ]', chr(10), p_brand)
            when 2 then concat(p_name, chr(10), '  ', p_size, ' ', chr(13), chr(10), p_type) when 3 then concat(repeat(chr(1), 60), p_name) when 4 then ''
            when 5 then concat(p_name, chr(13), chr(10), 'TITLE ', p_type) when 6 then concat(p_name, chr(10), p_retailprice) else concat(p_name, ' ATOM  ', p_size) end as body
from part"""


@named(
    "p15_format_by_content",
    r"""select p_partkey, case when body = '' then null
              when length(regexp_replace(body, '[^\x09-\x7e]', '', 'g')) / length(body) < 0.85 then case p_partkey % 3 when 0 then 'TPR' when 2 then 'TOP' end
              when regexp_matches(body, '(^|[\r\n])\s*\[\s*(defaults|atomtypes|moleculetype|system|molecules)\s*\]') then 'ITP'
              when regexp_matches(body, '(^|[\r\n])(ATOM  |HETATM|HEADER|CRYST1|MODEL |REMARK|TITLE |COMPND)') then 'PDB'
              when regexp_matches(regexp_extract(body, '^[^\r\n]*(\r\n|\n|\r)([^\r\n]*)', 2), '^\s*[+-]?[0-9]+\s*$') then 'GRO' end as format
       from v_heads""",
    {"v_heads": HEADS},
)
def _(i: Inputs):
    heads = query(i.spark, i.sf_dir, HEADS)
    return heads.select("p_partkey", rules.format_by_content(F.col("path"), F.col("body").cast("binary")).alias("format"))


@named("p16_is_background", f"select sim_id, atom_id, {BACKGROUND} as background from v_atoms")
def _(i: Inputs):
    return i.v_atoms.select("sim_id", "atom_id", rules.is_background(F.col("resname")).alias("background"))


@named(
    "p17_fix_elements",
    """select sim_id, atom_id, case when atom_id % 3 = 0 then case when left(name, 1) in ('C', 'N', 'O', 'S', 'P', 'H') then left(name, 1) else 'C' end
       else 'Xx' end as element from (select sim_id, atom_id, case when atom_id % 5 = 0 then 'ZN' else name end as name from v_atoms)""",
)
def _(i: Inputs):
    atoms = i.v_atoms.select(
        "sim_id", "atom_id", F.when(F.col("atom_id") % 5 == 0, "ZN").otherwise(F.col("name")).alias("name"),
        F.when(F.col("atom_id") % 3 == 0, "??").otherwise("Xx").alias("element"),
    )
    return op.fix_elements(atoms).drop("name")


NAMES = {
    "v_named": """
select p_partkey, case p_partkey % 8 when 0 then 'HG21' when 1 then 'ZN2' when 2 then 'na' when 3 then 'X1' when 4 then '' when 5 then '1HB' when 6 then 'Cl1' else 'BR' end as name,
       case p_partkey % 5 when 0 then 'Cl' when 1 then 'zn' when 2 then '' when 3 then 'Na' end as element from part""",
    "v_sym": f"select unnest([{quoted(fv.ELEMENTS)}]) as sym, unnest(range(1, {len(fv.ELEMENTS) + 1})) as num",
    "v_lead": """
select *, coalesce(element, '') as el, regexp_extract(name, '^[A-Za-z]+') as lead from v_named""",
    "v_nums": """
select l.*, coalesce(a.num, 0) as by_field, coalesce(b.num, 0) as two, coalesce(c.num, 0) as one from v_lead l
left join v_sym a on a.sym = concat(upper(left(el, 1)), lower(substr(el, 2)))
left join v_sym b on len(lead) >= 2 and b.sym = concat(upper(left(lead, 1)), lower(substr(lead, 2, 1)))
left join v_sym c on c.sym = upper(left(lead, 1))""",
}


@named(
    "p18_infer_element",
    """select p_partkey, cast(case when el <> '' and name <> '' and starts_with(upper(name), upper(el)) and by_field > 0 then by_field
              when upper(left(lead, 1)) in ('H', 'C', 'N', 'O', 'P', 'S') then one when two > 0 then two when one > 0 then one else by_field end as int) as z
       from v_nums""",
    NAMES,
)
def _(i: Inputs):
    rows = query(i.spark, i.sf_dir, NAMES["v_named"])
    return rows.select("p_partkey", rules.infer_element(F.col("name"), F.col("element")).alias("z"))


@named(
    "p19_has_box",
    """select frame as vec_id, cast(atom_id as bigint) as atom_id, case when frame % 3 = 0 then false when frame % 3 = 1 then false
              else abs(x) >= 1e-6 or abs(y) >= 1e-6 or abs(z) >= 1e-6 end as has_box from v_coords""",
)
def _(i: Inputs):
    """Every three floats of a vector as a box."""
    box = F.when(F.col("frame") % 3 == 0, F.lit(None)).when(
        F.col("frame") % 3 == 1, F.array(*[F.lit(v) for v in (0.0, 1e-7, -1e-8)])
    ).otherwise(F.array("x", "y", "z"))
    return i.v_coords.select(F.col("frame").alias("vec_id"), F.col("atom_id").cast("long").alias("atom_id"), rules.has_box(box).alias("has_box"))


@named(
    "p20_time_axis",
    r"""select run_id, bool_or(has) as has_time from (
         select run_id, case when contains(line, ' is a ') and contains(line, ' with ') then
           regexp_matches(replace(string_split(substr(line, instr(line, ' with ') + 6), ' Parm ')[1], '.', ','), '(^|,)\s*time\s*(,|$)') end as has
         from v_logs) group by run_id""",
)
def _(i: Inputs):
    return op.time_axis(i.v_logs)


def junk_sql(n: str) -> str:
    return rf"""({n} = '' or regexp_matches({n}, '^\d{{1,7}}-\d{{1,2}}-\d$') or regexp_matches({n}, '^\d[A-Za-z0-9]{{3}}$')
  or regexp_matches({n}, '^[A-Z]{{14}}-[A-Z]{{10}}-[A-Z]$') or contains({n}, ':') or len({n}) > 80 or (not contains({n}, ' ') and len({n}) > 30)
  or (not contains({n}, ' ') and regexp_matches({n}, '\d') and regexp_matches({n}, '\pL') and (upper({n}) = {n} or lower({n}) = {n})))"""


CANDIDATE = """
case doc_id % 8 when 0 then concat(doc_id % 9000 + 10, '-12-3') when 1 then concat(doc_id % 10, 'hvp') when 2 then 'ABCDEFGHIJKLMN-ABCDEFGHIJ-K'
       when 3 then concat('CHEBI:', doc_id) when 4 then concat('a', doc_id) when 6 then 'ATP' else line end"""
CANDIDATES = {"v_candidates": f"select doc_id, {CANDIDATE} as name from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)"}


@named("p21_is_junk", f"select doc_id, {junk_sql('n')} as junk from (select doc_id, trim(name, chr(32) || chr(10) || chr(9)) as n from v_candidates)", CANDIDATES)
def _(i: Inputs):
    """Names of every shape, among them the lines of the texts."""
    lines = i.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.select("doc_id", rules.is_junk(F.expr(CANDIDATE)).alias("junk"))


LAYERS = {
    "v_layers": """
select mol_id, inchi, canonical, split_part(inchi, '/', 2) as formula, regexp_extract(inchi, '/(c[^/]*)', 1) as c,
       regexp_extract(inchi, '/(t[^/]*)', 1) as t, regexp_extract(inchi, '/(p[^/]*)', 1) as pr from v_mols""",
}


@named("p22_inchi_layers", "select mol_id, formula, c, t, pr as p, inchi as raw from v_layers", LAYERS)
def _(i: Inputs):
    layers = rules.inchi_layers(F.col("inchi"))
    get = lambda k: rules.layer(layers, k).alias(k)
    return i.v_mols.select("mol_id", *[get(k) for k in ("formula", "c", "t", "p", "raw")])


SOFTWARE = {
    "v_soft": """
select id as simulation_id, case id % 6 when 0 then 'amber' when 1 then 'GROMACS' when 2 then 'namd' when 3 then 'unknown' when 4 then 'lammps' else 'desmond' end as software
from v_simulation""",
    "v_soft_files": "select page_id % 150 as simulation_id, regexp_replace(path, '^.*/', '') as filename from v_dir_files",
    "v_dim": "select * from (values " + ", ".join(f"('{s}', '{e}')" for s, es in fv.SOFTWARE_EXTENSIONS.items() for e in es) + ") d(software, extension)",
}


@named("p23_software_exts", "select s.simulation_id, d.extension from v_soft s join v_dim d on d.software = lower(s.software)", SOFTWARE)
def _(i: Inputs):
    return op.expected_extensions(query(i.spark, i.sf_dir, SOFTWARE["v_soft"])).select("simulation_id", "extension")


@named(
    "j20_missing_exts",
    """select simulation_id, software from v_soft s where lower(software) in (select software from v_dim) and not exists (
         select 1 from v_soft_files f join v_dim d on f.filename like concat('%', d.extension) where f.simulation_id = s.simulation_id and d.software = lower(s.software))""",
    SOFTWARE,
)
def _(i: Inputs):
    files = i.v_dir_files.select((F.col("page_id") % 150).alias("simulation_id"), text.basename(F.col("path")).alias("filename"))
    return op.missing_exts(query(i.spark, i.sf_dir, SOFTWARE["v_soft"]), files)


AA = "case upper(resname) " + " ".join(f"when '{k}' then '{v}'" for k, v in LETTERS.items()) + " else '' end"


@named("p24_aa1", f"select sim_id, atom_id, {AA} as aa from v_atoms")
def _(i: Inputs):
    return i.v_atoms.select("sim_id", "atom_id", rules.aa1(F.col("resname")).alias("aa"))


SIBLING = {
    "v_f": r"select distinct path, regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, regexp_extract(path, '([^/]*)\.[^./]*$', 1) as stem, regexp_extract(path, '\.[^./]*$') as ext from v_dir_files",
}


@named(
    "p28_match_sibling_prefix",
    """select b.path, coalesce((select min(path) from v_f c where c.dir = b.dir and c.ext = '.top' and c.stem = b.stem),
              (select min(path) from v_f c where c.dir = b.dir and c.ext = '.top' and (starts_with(c.stem, b.stem) or starts_with(b.stem, c.stem))),
              (select case when count(*) = 1 then min(path) end from v_f c where c.dir = b.dir and c.ext = '.top')) as match
       from v_f b where b.ext = '.gro'""",
    SIBLING,
)
def _(i: Inputs):
    return op.match_sibling(i.v_dir_files, ".gro", ".top", "prefix")


@named(
    "p28_match_sibling_exact",
    """select b.path, coalesce((select min(path) from v_f c where c.dir = b.dir and c.ext = '.tpr' and c.stem = b.stem),
              (select case when count(*) = 1 then min(path) end from v_f c where c.dir = b.dir and c.ext = '.tpr')) as match
       from v_f b where b.ext = '.top'""",
    SIBLING,
)
def _(i: Inputs):
    return op.match_sibling(i.v_dir_files, ".top", ".tpr", "exact")


# --- residues --------------------------------------------------------------
@named("a14_ligand_resnames", f"select sim_id, resname, count(*) as n_atoms from v_atoms where not {BACKGROUND} group by sim_id, resname")
def _(i: Inputs):
    return op.ligand_resnames(i.v_atoms)


# A structure of water only has no candidate.
WANTED = {
    "v_a": "select sim_id, atom_id, name, case when sim_id = 7 then 'SOL' else resname end as resname from v_atoms",
    "v_want": """select distinct sim_id, case when sim_id % 4 = 0 then 'LIG' when sim_id % 4 = 1 then 'ZZZ' when sim_id = 7 then 'QQQ' end as wanted from v_atoms""",
    "v_cand_names": f"select distinct sim_id, resname from v_a where not {BACKGROUND}",
}


@named(
    "a15_target_resnames",
    """select w.sim_id, case when h.resname is not null then wanted else c.resname end as resname,
              case when h.resname is null and c.resname is null then case when wanted is null then 'no candidate' else 'name absent and no candidate' end end as error
       from v_want w left join (select distinct sim_id, resname from v_a) h on h.sim_id = w.sim_id and h.resname = w.wanted
       left join v_cand_names c on c.sim_id = w.sim_id and h.resname is null""",
    WANTED,
)
def _(i: Inputs):
    atoms = query(i.spark, i.sf_dir, WANTED["v_a"])
    return op.target_resnames(atoms, query(i.spark, i.sf_dir, WANTED["v_want"]))


@named(
    "a16_first_residue",
    """select a.sim_id, t.target, a.atom_id, a.resix from (select distinct sim_id, case when sim_id % 2 = 0 then 'LIG' when sim_id % 3 = 0 then 'cov' else 'SEP' end as target from v_atoms) t
       join v_atoms a on a.sim_id = t.sim_id and upper(a.resname) = upper(t.target)
       qualify a.resix = min(a.resix) over (partition by a.sim_id, t.target)""",
)
def _(i: Inputs):
    atoms = i.v_atoms
    target = F.when(F.col("sim_id") % 2 == 0, "LIG").when(F.col("sim_id") % 3 == 0, "cov").otherwise("SEP")
    targets = atoms.select("sim_id", target.alias("target")).distinct()
    return op.first_residue(atoms, targets).select("sim_id", "target", "atom_id", "resix")


@named(
    "a17_system_flags",
    f"select sim_id, bool_or(resname in ({quoted(fv.STRIP_LIPIDS)})) as has_lipid, bool_or(name in ('CA', 'C', 'N')) as has_backbone from v_coord_atoms group by sim_id",
)
def _(i: Inputs):
    return op.system_flags(i.v_coord_atoms)


STRIPPED = "select sim_id, frame, case when sim_id = 1 and atom_id >= 15 then 0 else atom_id end as atom_id from v_traj"


@named(
    "a18_prestripped",
    """select t.sim_id, t.n as top_atoms, j.n as traj_atoms, j.n < t.n as prestripped
       from (select sim_id, count(distinct atom_id) as n from v_coord_atoms group by 1) t
       join (select sim_id, count(distinct atom_id) as n from v_cut group by 1) j on j.sim_id = t.sim_id""",
    {"v_cut": STRIPPED},
)
def _(i: Inputs):
    return op.prestripped(query(i.spark, i.sf_dir, STRIPPED), i.v_coord_atoms)


@named(
    "a19_natoms_mismatch",
    """select t.sim_id, t.n as top_atoms, j.n as coord_atoms
       from (select sim_id, count(distinct atom_id) as n from v_coord_atoms group by 1) t
       join (select sim_id, count(distinct atom_id) as n from v_cut where frame = 0 group by 1) j on j.sim_id = t.sim_id
       where t.n <> j.n""",
    {"v_cut": STRIPPED},
)
def _(i: Inputs):
    return op.natoms_mismatch(query(i.spark, i.sf_dir, STRIPPED).where("frame = 0"), i.v_coord_atoms)


# One structure without a residue that has a letter.
CHAINS = """
select sim_id, atom_id as line_no, case when sim_id = 3 then 'LIG' else resname end as resname, resix as residue, chain from v_atoms"""
SEQ = {
    "v_chains": CHAINS,
    "v_res": f"""
select sim_id, case when trim(chain) = '' then '_' else chain end as chain, residue, min(line_no) as pos, any_value({AA}) as aa
from v_chains group by sim_id, chain, residue""",
    "v_chain": "select sim_id, chain, min(pos) as line, bool_or(aa <> '') as used, string_agg(aa, '' order by pos) filter (aa <> '') as sequence from v_res group by 1, 2",
    "v_num": "select *, row_number() over (partition by sim_id order by line) as number from v_chain where used",
}


@named(
    "a23_chain_sequences",
    r"""select sim_id, chain, cast(number as int) as number, sequence, cast(null as varchar) as error from v_num where not regexp_matches(sequence, '^X+$')
        union all select distinct sim_id, null, null, null, 'no sequence' from v_res where sim_id not in (select sim_id from v_num)""",
    SEQ,
)
def _(i: Inputs):
    return op.chain_sequences(query(i.spark, i.sf_dir, CHAINS))


REF_ATOMS = {
    "v_ref": """select sim_id, case when atom_id % 7 <> 0 and resix % 50 <> 3 then resix % 50 end as resnum, chain, atom_id as line_no from v_atoms""",
}


@named(
    "j17_restore_chains",
    """select a.sim_id, a.atom_id, coalesce(r.chain, '?') as chain from v_atoms a left join (
         select sim_id, resnum, arg_max(chain, line_no) as chain from v_ref where trim(chain) <> '' group by 1, 2) r on r.sim_id = a.sim_id and r.resnum = a.resix % 50""",
    REF_ATOMS,
)
def _(i: Inputs):
    target = i.v_atoms.select("sim_id", "atom_id", (F.col("resix") % 50).alias("resnum"), F.lit("?").alias("chain"))
    return op.restore_chains(target, query(i.spark, i.sf_dir, REF_ATOMS["v_ref"])).select("sim_id", "atom_id", "chain")


# --- frames ----------------------------------------------------------------
GONE = quoted(fv.STRIP_WATER + fv.STRIP_IONS)
KEPT = {
    "v_kept": f"select * from v_coord_atoms where resname not in ({GONE}, {quoted(fv.STRIP_LIPIDS)})",
    "v_kept_lipid": f"""select * from v_coord_atoms a where resname not in ({GONE})
        and exists (select 1 from v_coord_atoms l where l.sim_id = a.sim_id and l.resname in ({quoted(fv.STRIP_LIPIDS)}))""",
}


@named("u4_strip", "select c.sim_id, c.frame, c.atom_id from v_traj c join v_kept k on k.sim_id = c.sim_id and k.atom_id = c.atom_id", KEPT)
def _(i: Inputs):
    return op.strip(i.v_coord_atoms, i.v_traj)[1].select("sim_id", "frame", "atom_id")


@named("u4_strip_keep_lipids", "select c.sim_id, c.frame, c.atom_id from v_traj c join v_kept_lipid k on k.sim_id = c.sim_id and k.atom_id = c.atom_id", KEPT)
def _(i: Inputs):
    return op.strip(i.v_coord_atoms, i.v_traj, keep_lipids=True)[1].select("sim_id", "frame", "atom_id")


@named(
    "a20_rmsf",
    "select sim_id, atom_id, round(sqrt(var_pop(x) + var_pop(y) + var_pop(z)), 6) as rmsf from v_traj group by sim_id, atom_id",
)
def _(i: Inputs):
    return tr.rmsf(i.v_traj).withColumn("rmsf", F.round("rmsf", 6))


def rmsd_sql(points: str, ref: str, tag: str = "r") -> dict[str, str]:
    """DuckDB views for the RMSD of frames of ``points`` against ``ref``."""
    axes = "xyz"
    pairs = [(p, q) for p in axes for q in axes]
    sums = ", ".join(
        [f"sum(c.{p}) as s{p}, sum(r.{p}) as t{p}" for p in axes] + [f"sum(c.{p} * r.{q}) as p{p}{q}" for p, q in pairs]
    )
    cent = ", ".join(f"p{p}{q} - s{p} * t{q} / n as m{p}{q}" for p, q in pairs)
    sq = ", ".join(f"mx{p} * mx{q} + my{p} * my{q} + mz{p} * mz{q} as q{p}{q}" for p, q in pairs)
    det = lambda m: (
        f"({m('x', 'x')}) * (({m('y', 'y')}) * ({m('z', 'z')}) - ({m('y', 'z')}) * ({m('z', 'y')}))"
        f" - ({m('x', 'y')}) * (({m('y', 'x')}) * ({m('z', 'z')}) - ({m('y', 'z')}) * ({m('z', 'x')}))"
        f" + ({m('x', 'z')}) * (({m('y', 'x')}) * ({m('z', 'y')}) - ({m('y', 'y')}) * ({m('z', 'x')}))"
    )
    shifted = det(lambda p, q: f"q{p}{q} - t" if p == q else f"q{p}{q}")
    return {
        f"v_{tag}1": f"""select c.sim_id, c.frame, count(*)::double as n, sum(c.x * c.x + c.y * c.y + c.z * c.z) as pp, sum(r.x * r.x + r.y * r.y + r.z * r.z) as rr, {sums}
            from {points} c join {ref} r on r.sim_id = c.sim_id and r.atom_id = c.atom_id group by c.sim_id, c.frame""",
        f"v_{tag}2": f"""select sim_id, frame, n, pp - (sx * sx + sy * sy + sz * sz) / n as gp, rr - (tx * tx + ty * ty + tz * tz) / n as gr, {cent} from v_{tag}1""",
        f"v_{tag}3": f"select *, {sq}, {det(lambda p, q: f'm{p}{q}')} as dr from v_{tag}2",
        f"v_{tag}4": f"select *, (qxx + qyy + qzz) / 3 as t from v_{tag}3",
        f"v_{tag}5": f"""select *, sqrt(((qxx - t) ** 2 + (qyy - t) ** 2 + (qzz - t) ** 2 + 2 * (qxy ** 2 + qxz ** 2 + qyz ** 2)) / 6) as w, {shifted} as d from v_{tag}4""",
        f"v_{tag}6": f"select *, case when w = 0 then 0 else acos(greatest(-1, least(1, d / (2 * w ** 3)))) / 3 end as phi from v_{tag}5",
        f"v_{tag}7": f"select *, t + 2 * w * cos(phi) as e1, t + 2 * w * cos(phi + 2 * pi() / 3) as e3 from v_{tag}6",
        f"v_{tag}_rmsd": f"""select sim_id, frame, sqrt(greatest(0, (gp + gr - 2 * (sqrt(greatest(e1, 0)) + sqrt(greatest(3 * t - e1 - e3, 0)) + sign(dr) * sqrt(greatest(e3, 0)))) / n)) as rmsd
            from v_{tag}7""",
    }


# C-alpha atoms where a structure has them, else all atoms.
CA = {
    "v_ca": """select * from v_coord_atoms a where name = 'CA' or not exists (select 1 from v_coord_atoms b where b.sim_id = a.sim_id and b.name = 'CA')""",
    "v_ca_xyz": "select c.* from v_traj c join v_ca a on a.sim_id = c.sim_id and a.atom_id = c.atom_id",
    "v_ca_ref": "select * from v_ca_xyz where frame = 0",
    **rmsd_sql("v_ca_xyz", "v_ca_ref"),
}
# Rounding noise on the reference frame is around 1e-8; five places hide it.
PLACES = 5


@named("a21_rmsd", f"select sim_id, frame, round(rmsd, {PLACES}) as rmsd from v_r_rmsd", CA)
def _(i: Inputs):
    series = tr.rmsd(i.v_traj, atoms=op.select_atoms(i.v_coord_atoms, ["CA"]))
    return series.withColumn("rmsd", F.round("rmsd", PLACES))


@named("t4_fit_selection", """select sim_id, atom_id from v_coord_atoms a where name in ('CA', 'C', 'N')
    or not exists (select 1 from v_coord_atoms b where b.sim_id = a.sim_id and b.name in ('CA', 'C', 'N'))""")
def _(i: Inputs):
    return op.select_atoms(i.v_coord_atoms).select("sim_id", "atom_id")


@named(
    "a22_gate",
    """select p.sim_id, round(max(v.value), 6) as max_value, case when max(v.value) is null then 'no values' when max(v.value) > 0.45 then 'above the limit' end as reason,
              coalesce(max(v.value) <= 0.45, false) as accepted
       from (select distinct vec_id as sim_id from embeddings) p left join
            (select vec_id as sim_id, case when label % 5 <> 0 then cast(v as double) end as value
             from (select vec_id, label, unnest(embedding) as v from embeddings)) v on v.sim_id = p.sim_id group by p.sim_id""",
)
def _(i: Inputs):
    """The floats of a vector as a series; some series have no values."""
    value = F.when(F.col("label") % 5 != 0, F.col("v").cast("double"))
    every = i.embeddings.select("vec_id", "label", F.explode("embedding").alias("v"))
    series = every.select(F.col("vec_id").alias("sim_id"), value.alias("value"))
    out = tr.gate(series, series, 0.45)
    return out.withColumn("max_value", F.round("max_value", 6))


@named(
    "w5_stride_sample",
    """select server, id from (select server, id, row_number() over (partition by server order by id) as rn, count(*) over (partition by server) as n from v_job)
       where n <= 100 or (rn - 1) % (n // 100) = 0""",
)
def _(i: Inputs):
    return tr.stride_sample(i.v_job.select("server", "id"), "server", "id", 100)


@named(
    "w6_sample_frames",
    """select c.sim_id, c.frame, c.atom_id from v_traj c join (
         select sim_id, frame, row_number() over (partition by sim_id order by frame) as rn, count(*) over (partition by sim_id) as n from (select distinct sim_id, frame from v_traj)) f
       on f.sim_id = c.sim_id and f.frame = c.frame
       where rn <= 1000 and (rn - 1) % case when least(n, 1000) > 100 then least(n, 1000) // 100 else 1 end = 0""",
)
def _(i: Inputs):
    return tr.sample_frames(i.v_traj).select("sim_id", "frame", "atom_id")


@named("t5_first_frame", "select c.sim_id, c.atom_id, a.name, a.resname, round(x, 6) as x from v_traj c join v_coord_atoms a on a.sim_id = c.sim_id and a.atom_id = c.atom_id where frame = 0")
def _(i: Inputs):
    return tr.first_frame(i.v_traj, i.v_coord_atoms).select("sim_id", "atom_id", "name", "resname", F.round("x", 6).alias("x"))


@named("t1_superpose", f"select sim_id, frame, round(rmsd, {PLACES}) as deviation from v_r_rmsd", CA)
def _(i: Inputs):
    """After the fit, the plain distance to the reference is the RMSD."""
    fit = op.select_atoms(i.v_coord_atoms, ["CA"])
    ref = tr.first_frame(i.v_traj)
    moved = tr.selected(tr.superpose(i.v_traj, ref, fit), fit)
    r = ref.select("sim_id", "atom_id", *[F.col(c).alias(f"r{c}") for c in "xyz"])
    d2 = sum(((F.col(c) - F.col(f"r{c}")) ** 2 for c in "xyz"), F.lit(0.0))
    return moved.join(r, ["sim_id", "atom_id"]).groupBy("sim_id", "frame").agg(
        F.round(F.sqrt(F.avg(d2)), PLACES).alias("deviation")
    )


AXES = {
    "v_one": "select * from v_traj where frame = 0",
    "v_m": """select sim_id, covar_pop(x, x) as qxx, covar_pop(y, y) as qyy, covar_pop(z, z) as qzz, covar_pop(x, y) as qxy, covar_pop(x, z) as qxz, covar_pop(y, z) as qyz from v_one group by sim_id""",
    "v_m1": "select *, (qxx + qyy + qzz) / 3 as t from v_m",
    "v_m2": """select *, sqrt(((qxx - t) ** 2 + (qyy - t) ** 2 + (qzz - t) ** 2 + 2 * (qxy ** 2 + qxz ** 2 + qyz ** 2)) / 6) as w,
               (qxx - t) * ((qyy - t) * (qzz - t) - qyz * qyz) - qxy * (qxy * (qzz - t) - qyz * qxz) + qxz * (qxy * qyz - (qyy - t) * qxz) as d from v_m1""",
    "v_m3": "select *, acos(greatest(-1, least(1, d / (2 * w ** 3)))) / 3 as phi from v_m2",
    "v_e": "select sim_id, t, t + 2 * w * cos(phi) as e1, t + 2 * w * cos(phi + 2 * pi() / 3) as e3 from v_m3",
}


@named("t2_orient_reference", "select sim_id, round(3 * t - e1 - e3, 6) as var_x, round(e3, 6) as var_y, round(e1, 6) as var_z, round(0.0::double, 6) as cov_xz from v_e", AXES)
def _(i: Inputs):
    """The longest axis ends up along z, the second along x."""
    turned = tr.orient_reference(tr.first_frame(i.v_traj))
    cov = F.round(F.abs(F.round(F.covar_pop("x", "z"), 6)), 6)
    return turned.groupBy("sim_id").agg(
        *[F.round(F.var_pop(c), 6).alias(f"var_{c}") for c in "xyz"], cov.alias("cov_xz")
    )


MINIMAL = {
    **KEPT,
    "v_fit": """select * from v_kept a where name in ('CA', 'C', 'N') or not exists (select 1 from v_kept b where b.sim_id = a.sim_id and b.name in ('CA', 'C', 'N'))""",
    "v_fit_xyz": "select c.* from v_traj c join v_fit a on a.sim_id = c.sim_id and a.atom_id = c.atom_id",
    "v_fit_ref": "select * from v_fit_xyz where frame = 0",
    **rmsd_sql("v_fit_xyz", "v_fit_ref"),
    "v_size": """select c.sim_id, c.frame, count(*) as n_atoms, sqrt(var_pop(x) + var_pop(y) + var_pop(z)) as gyration
                 from v_traj c join v_kept k on k.sim_id = c.sim_id and k.atom_id = c.atom_id group by 1, 2""",
}


@named(
    "t3_minimal",
    f"select s.sim_id, s.frame, s.n_atoms, round(s.gyration, {PLACES}) as gyration, round(r.rmsd, {PLACES}) as deviation from v_size s join v_r_rmsd r on r.sim_id = s.sim_id and r.frame = s.frame",
    MINIMAL,
)
def _(i: Inputs):
    """Shape is kept, and the fit atoms are as close to the first frame as a
    rigid motion allows."""
    atoms = i.v_coord_atoms
    fitted, first = tr.minimal(atoms, i.v_traj)
    size = fitted.groupBy("sim_id", "frame").agg(
        F.count(F.lit(1)).alias("n_atoms"),
        F.round(F.sqrt(F.var_pop("x") + F.var_pop("y") + F.var_pop("z")), PLACES).alias("gyration"),
    )
    fit = op.select_atoms(op.kept_atoms(atoms))
    r = first.select("sim_id", "atom_id", *[F.col(c).alias(f"r{c}") for c in "xyz"])
    d2 = sum(((F.col(c) - F.col(f"r{c}")) ** 2 for c in "xyz"), F.lit(0.0))
    off = tr.selected(fitted, fit).join(r, ["sim_id", "atom_id"]).groupBy("sim_id", "frame").agg(
        F.round(F.sqrt(F.avg(d2)), PLACES).alias("deviation")
    )
    return size.join(off, ["sim_id", "frame"])


# --- molecules -------------------------------------------------------------
# Each molecule against the next one.
COMPARE = {
    **LAYERS,
    "v_pair": """
select a.mol_id, a.canonical as k1, b.canonical as k2, a.inchi as i1, b.inchi as i2, a.c as c1, b.c as c2, a.t as t1, b.t as t2, a.pr as p1, b.pr as p2,
       a.formula as f1, b.formula as f2, a.c = b.c and a.c <> '' as conn from v_layers a join v_layers b on b.mol_id = a.mol_id + 1""",
}


@named(
    "c1_compare_molecules",
    """select mol_id, k1 = k2 as exact_match, conn as same_connectivity, conn and t1 = t2 as same_connectivity_and_stereo, i1 = i2 as same_inchi,
              case when conn then concat_ws('; ', case when f1 <> f2 then concat('formula (', f1, ' vs ', f2, ')') end, case when p1 <> p2 then 'protonation' end,
                   case when t1 <> t2 then 'tetrahedral stereo' end) else 'connectivity (different molecules)' end as differences,
              case when conn then c1 end as connectivity_layer
       from v_pair""",
    COMPARE,
)
def _(i: Inputs):
    m = i.v_mols
    nxt = m.select((F.col("mol_id") - 1).alias("mol_id"), F.col("canonical").alias("canonical2"), F.col("inchi").alias("inchi2"))
    pairs = m.select("mol_id", F.col("canonical").alias("canonical1"), F.col("inchi").alias("inchi1")).join(nxt, "mol_id")
    return mol.compare_molecules(pairs).select(
        "mol_id", "exact_match", "same_connectivity", "same_connectivity_and_stereo", "same_inchi",
        F.array_join("differences", "; ").alias("differences"), "connectivity_layer",
    )


for _level, _key in {
    "exact": "canonical", "connectivity": "nullif(c, '')",
    "stereo": "case when c <> '' then concat(c, '/', t, '//') end", "inchi": "inchi",
}.items():

    def _groups(i: Inputs, level: str = _level):
        return mol.identity_groups(i.v_mols, level).select("mol_id", "group_id", "group_size")

    named(
        f"c2_identity_groups_{_level}",
        f"select mol_id, min(mol_id) over (partition by {_key}) as group_id, count(*) over (partition by {_key}) as group_size from v_layers",
        LAYERS,
    )(_groups)


NAMING = {
    "v_keyed": "select mol_id, concat('K', mol_id % 97) as inchikey from v_mols",
    "v_labels": """select distinct concat('K', p_size % 120) as inchikey, case p_size % 4 when 0 then concat('Q', p_size) when 1 then 'A2P5P' when 2 then p_name else 'adenosine' end as label from part""",
    "v_titles": "select distinct concat('K', p_partkey % 80) as inchikey, concat('title ', p_partkey % 80) as title from part",
    "v_xrefs": "select distinct concat('K', p_partkey % 90) as inchikey, cast(p_partkey % 7 as string) as src_id, concat('X', p_partkey % 40) as src_compound_id from part",
    "v_compounds": "select distinct concat('X', p_partkey % 30) as compound_id, case when p_partkey % 30 < 4 then ' ' else concat('compound ', p_partkey % 30) end as name from part",
    "v_synonyms": """select mol_id, pos, case (mol_id + pos) % 6 when 0 then 'CHEMBL123' when 1 then concat(mol_id % 90, '-12-3') when 2 then 'CHEBI:1' when 3 then 'orb17' else
                     case when mol_id % 5 = 0 then concat('syn ', pos) else concat(pos, 'abc') end end as synonym
                     from (select p_partkey as mol_id, cast(l_linenumber as bigint) - 1 as pos from (select distinct l_partkey as p_partkey, l_linenumber from lineitem) k) s""",
    "v_best_syn": f"select mol_id, arg_min(synonym, pos) filter (not {junk_sql('synonym')}) as synonym from v_synonyms group by mol_id",
    "v_looked": r"""
select k.mol_id, k.inchikey, l.label, t.title, c.name as compound_name from v_keyed k
left join (select inchikey, min(trim(label)) as label from v_labels where trim(label) <> '' and not regexp_matches(trim(label), '^Q\d+$') group by 1) l on l.inchikey = k.inchikey
left join (select inchikey, min(title) as title from v_titles group by 1) t on t.inchikey = k.inchikey
left join (select inchikey, min(src_compound_id) as cid from v_xrefs where src_id = '5' group by 1) x on x.inchikey = k.inchikey
left join (select compound_id, min(trim(name)) as name from v_compounds where trim(name) <> '' group by 1) c on c.compound_id = x.cid""",
    "v_named": "select k.*, s.synonym from v_looked k left join v_best_syn s on s.mol_id = k.mol_id",
}


def _looked(i: Inputs):
    get = lambda n: query(i.spark, i.sf_dir, NAMING[n])
    mols = i.v_mols.select("mol_id", F.concat(F.lit("K"), (F.col("mol_id") % 97).cast("string")).alias("inchikey"))
    return mol.lookup_names(mols, get("v_labels"), get("v_titles"), get("v_xrefs"), get("v_compounds"))


@named("j19_lookup_names", "select mol_id, inchikey, label, title, compound_name from v_looked", NAMING)
def _(i: Inputs):
    return _looked(i)


@named("w10_best_synonym", """select s.mol_id, s.synonym, e.evidence from v_best_syn s join (select mol_id, string_agg(synonym, '|' order by pos) filter (pos < 3) as evidence
    from v_synonyms group by mol_id) e on e.mol_id = s.mol_id""", NAMING)
def _(i: Inputs):
    out = mol.best_synonym(query(i.spark, i.sf_dir, NAMING["v_synonyms"]), keep=3)
    return out.withColumn("evidence", F.nullif(F.array_join("evidence", "|"), F.lit("")))


LABEL_JUNK = f"coalesce({junk_sql('label')}, true)"


@named(
    "c3_best_names",
    rf"""select mol_id, case when ok and regexp_matches(label, '\p{{Ll}}') then label when coalesce(synonym, '') <> '' then synonym when ok then label
            when compound_name is not null then compound_name when title is not null then title else 'unknown' end as best_name,
            case when ok and regexp_matches(label, '\p{{Ll}}') then 'wikidata' when coalesce(synonym, '') <> '' then 'pubchem_synonyms' when ok then 'wikidata'
            when compound_name is not null then 'pdbe' when title is not null then 'pubchem_title' end as name_source
         from (select *, not {LABEL_JUNK} as ok from v_named)""",
    NAMING,
)
def _(i: Inputs):
    synonyms = mol.best_synonym(query(i.spark, i.sf_dir, NAMING["v_synonyms"])).drop("evidence")
    return mol.best_names(_looked(i).join(synonyms, "mol_id", "left")).select("mol_id", "best_name", "name_source")


BATCHES = """select l_orderkey as batch, l_linenumber as pos, min(concat('C', l_partkey)) as smiles, min(l_suppkey) % 9 <> 0 as valid
from lineitem group by l_orderkey, l_linenumber"""


@named("c4_checked_batch", "select batch, pos, smiles from v_b where batch not in (select batch from v_b where not valid)", {"v_b": BATCHES})
def _(i: Inputs):
    rows = query(i.spark, i.sf_dir, BATCHES)
    return mol.checked_batch(rows, "batch", "pos", "smiles", F.col("valid"))[0].select("batch", "pos", "smiles")


@named("c4_batch_offenders", "select batch, arg_min(smiles, pos) as offender, min(pos) as at from v_b where not valid group by batch", {"v_b": BATCHES})
def _(i: Inputs):
    rows = query(i.spark, i.sf_dir, BATCHES)
    return mol.checked_batch(rows, "batch", "pos", "smiles", F.col("valid"))[1]
