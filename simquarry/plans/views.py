"""Repository-shaped inputs derived from the given tables.

Each view is one SQL text that is valid in Spark and in DuckDB; where the two
differ, a second text gives the DuckDB form.  ``view`` builds a DataFrame from
common table expressions over the parquet files, so nothing is registered in
the session and Catalyst prunes and pushes down through the whole text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {}
DUCK: dict[str, str] = {}

VIEWS["v_user"] = """
select c_custkey as id, c_name as username,
       case when c_custkey % 7 = 0 then '' else 'Customer' end as first_name,
       case when c_custkey % 7 = 0 then '' else cast(c_custkey as string) end as last_name,
       c_mktsegment as institution, concat(c_name, '@example.org') as email
from customer"""

VIEWS["v_account"] = """
select c_custkey as user_id, case when c_custkey % 3 = 0 or c_custkey % 5 = 0 then 'github' else 'orcid' end as provider,
       concat('0000-0000-', lpad(cast(c_custkey as string), 8, '0')) as uid
from customer
union all
select c_custkey as user_id, 'orcid' as provider, concat('0000-0001-', lpad(cast(c_custkey as string), 8, '0')) as uid
from customer where c_custkey % 10 = 1"""

VIEWS["v_landing"] = """
select l_orderkey as ticket_id, l_linenumber as part,
       concat('L', l_orderkey, '-', l_linenumber) as landing_id,
       concat('/z/landing/L', l_orderkey, '-', l_linenumber) as collection,
       min(l_partkey) as partkey, max(l_linestatus) as linestatus,
       min(l_returnflag) as returnflag, max(l_discount) as discount
from lineitem group by l_orderkey, l_linenumber"""

VIEWS["v_entry"] = """
select ticket_id, part, case when (ticket_id + part) % 17 = 0 then concat('bad-', landing_id)
                             else concat('MDRSubmit_', landing_id, ':', collection) end as entry
from v_landing"""

VIEWS["v_ticket"] = """
select o.o_orderkey as id, o.o_custkey as created_by_id, o.o_orderdate as created_at,
       case when o.o_orderpriority = '5-LOW' then 'd' else 'u' end as ticket_type,
       o.o_orderstatus = 'F' as upload_notification_sent,
       o.o_orderstatus = 'P' as processing_complete,
       p.irods_tickets
from orders o left join (
  select ticket_id, string_agg(entry, ';' order by part) as irods_tickets
  from v_entry group by ticket_id) p on p.ticket_id = o.o_orderkey"""

VIEWS["v_objects"] = """
select collection, 'mdrepo-submission.completed.json' as name,
       case when (ticket_id + part) % 11 = 0 then 0 else 5039 end as size,
       md5(landing_id) as md5
from v_landing where (ticket_id * 3 + part) % 13 <> 0
union all
select distinct concat('/z/landing/L', l_orderkey, '-', l_linenumber) as collection,
       concat('part-', l_partkey, '.xtc') as name,
       cast(l_partkey % 1000 + 1 as int) as size,
       md5(concat('f', l_orderkey, '-', l_linenumber, '-', l_partkey)) as md5
from lineitem"""

VIEWS["v_manifest"] = """
select collection, name,
       case when size % 19 = 0 then md5(concat('x', md5)) else md5 end as md5
from v_objects where name <> 'mdrepo-submission.completed.json' and size % 23 <> 0"""

# Copies of the objects on local disk: some missing, short, damaged or unread.
VIEWS["v_copies"] = """
select collection, case when size % 29 = 0 then concat(name, '~') else name end as name,
       case when size % 13 = 0 then size - 1 else size end as size,
       case when size % 31 = 0 then null when size % 17 = 0 then md5(concat('y', md5)) else md5 end as md5
from v_objects"""

VIEWS["v_job"] = """
select event_id as id, user_id as ticket_id,
       case when event_id % 3 = 0 then 'prod' else 'staging' end as server,
       case event_type when 'view' then 'pending' when 'signup' then 'pending'
                       when 'click' then 'running' when 'purchase' then 'succeeded'
                       else 'failed' end as status,
       cast(case when event_type = 'signup' then 1 + event_id % 5 else 0 end as int) as num_attempts,
       ts as created_at,
       case when event_type in ('view', 'signup') then null else ts end as started_at,
       case when event_type in ('view', 'click') then null
            else ts + interval '7' minute end as finished_at,
       case when event_type = 'error' then
            case when event_id % 4 = 0 then 'NetworkException: x' else 'bad topology' end end as last_error
from events"""

VIEWS["v_upload"] = """
select ticket_id, landing_id,
       case when returnflag = 'N' and part % 2 = 0 then null else partkey end as simulation_id,
       linestatus = 'F' as successful, discount >= 0.1 as is_abandoned
from v_landing"""

VIEWS["v_simulation"] = """
select p_partkey as id, p_name as alias, p_brand as software_name, p_type as forcefield,
       case when p_partkey % 29 = 0 then null else p_size % 5 = 0 end as is_placeholder
from part where p_partkey % 31 <> 0"""

VIEWS["v_files"] = """
select p_partkey as simulation_id,
       concat('MDR', lpad(cast(p_partkey as string), 8, '0'), '/', k.kind, '/f', k.n) as local_file_path,
       k.kind, cast(p_size * 100 + k.n as int) as file_size_bytes, md5(concat(p_partkey, '-', k.n)) as md5_hash
from part lateral view explode(array(named_struct('kind', 'processed', 'n', 1),
     named_struct('kind', 'processed', 'n', 2), named_struct('kind', 'original', 'n', 3))) t as k
where p_partkey % 37 <> 0"""

DUCK["v_files"] = """
select p_partkey as simulation_id,
       concat('MDR', lpad(cast(p_partkey as string), 8, '0'), '/', k.kind, '/f', k.n) as local_file_path,
       k.kind, cast(p_size * 100 + k.n as int) as file_size_bytes, md5(concat(p_partkey, '-', k.n)) as md5_hash
from part cross join (select 'processed' as kind, 1 as n union all select 'processed', 2
                      union all select 'original', 3) k
where p_partkey % 37 <> 0"""

VIEWS["v_release"] = """
select local_file_path as path,
       case when simulation_id % 41 = 0 then file_size_bytes + 1 else file_size_bytes end as size,
       case when simulation_id % 43 = 0 then null when simulation_id % 47 = 0 then md5('stale')
            else md5_hash end as checksum
from v_files where (simulation_id + file_size_bytes) % 53 <> 0"""

VIEWS["v_runs"] = """
select concat('job-', user_id) as label, ts, event_id as seq,
       case when event_type in ('error', 'click', 'view') then 1 else 0 end as exit_code,
       event_id % 7 <> 0 as delivered
from events"""

VIEWS["v_bundle_objects"] = """
select concat('b', doc_id, case when doc_id % 5 = 0 then '.data' else '.md5' end) as name,
       case when doc_id % 9 = 0 then 0 else n_chars end as size,
       timestamp '2024-01-01 00:00:00' + (doc_id * 7919 % 100003) * interval '1' second as create_time
from documents"""

VIEWS["v_outcomes"] = """
select event_id as seq, ts, concat('b', cast(floor(event_id / 20) as bigint)) as bundle,
       case when event_type = 'error' then 'failed' else 'done' end as result
from events where event_id % 5 in (1, 2)"""

_REPLICA = """
select concat('/z/backup/', doc_id) as path, r.n as replica_no, concat('res', r.n) as resource,
       case when doc_id % 14 = 0 and r.n = 1 then n_chars - 1 else n_chars end as size,
       case when doc_id % 15 = 0 and r.n = 1 then 0 else 1 end as status,
       case when doc_id % 16 = 0 and r.n = 1 then null when doc_id % 21 = 0 and r.n = 1 then md5('old')
            else md5(text) end as checksum
from documents {replicas}
where not (doc_id % 22 = 0 and r.n = 1)"""
VIEWS["v_replicas"] = _REPLICA.format(
    replicas="lateral view explode(array(named_struct('n', 0), named_struct('n', 1))) t as r"
)
DUCK["v_replicas"] = _REPLICA.format(replicas="cross join (select 0 as n union all select 1) r")

VIEWS["v_backup"] = """
select concat('/z/backup/', doc_id) as path, case when doc_id % 25 = 0 then n_chars + 3 else n_chars end as size,
       n_chars as expected_size, md5(text) as expected_md5
from documents"""

VIEWS["v_atoms"] = """
select distinct cast(l_orderkey % 20 as int) as sim_id, l_orderkey * 8 + l_linenumber as atom_id,
       case l_linenumber % 4 when 0 then 'O' when 1 then 'CA' when 2 then 'N' else 'C' end as name,
       case cast(floor(l_orderkey / 20) as int) % 12
            when 0 then 'ALA' when 1 then 'GLY' when 2 then 'HIE' when 3 then 'SEP'
            when 4 then 'ACE' when 5 then 'SOL' when 6 then 'NA+' when 7 then 'POPC'
            when 8 then 'LIG' when 9 then 'HOH' when 10 then 'COV' else 'TRP' end as resname,
       l_orderkey as resix,
       case cast(floor(l_orderkey / 240) as int) % 3 when 0 then 'A' when 1 then 'B' else ' ' end as chain
from lineitem"""

VIEWS["v_mols"] = """
select p_partkey as mol_id,
       concat('InChI=1S/C', p_size % 7 + 1, 'H', p_size % 5, '/c1-', p_size % 9,
              case when p_partkey % 3 = 0 then '/t1-' else '' end,
              case when p_partkey % 4 = 0 then '/p+1' else '' end) as inchi,
       concat('C', p_size % 11) as canonical, p_name as label
from part"""

# An atom for every three floats of an embedding; the last one's missing floats
# are 0.  The second text per engine differs only in list functions.
VIEWS["v_coords"] = """
select 0 as sim_id, vec_id as frame, a as atom_id, coalesce(cast(get(embedding, 3 * a) as double), 0D) as x,
       coalesce(cast(get(embedding, 3 * a + 1) as double), 0D) as y, coalesce(cast(get(embedding, 3 * a + 2) as double), 0D) as z
from (select * from embeddings where size(embedding) > 0) lateral view explode(sequence(0, cast(ceil(size(embedding) / 3) as int) - 1)) t as a"""
DUCK["v_coords"] = """
select 0 as sim_id, vec_id as frame, id as atom_id, coalesce(cast(embedding[3 * id + 1] as double), 0) as x,
       coalesce(cast(embedding[3 * id + 2] as double), 0) as y, coalesce(cast(embedding[3 * id + 3] as double), 0) as z
from (select vec_id, embedding, unnest(range(cast(ceil(len(embedding) / 3.0) as bigint))) as id from embeddings)"""

# The same frames as three trajectories.
VIEWS["v_traj"] = """
select cast(frame % 3 as int) as sim_id, cast(floor(frame / 3) as bigint) as frame, cast(atom_id as bigint) as atom_id, x, y, z
from v_coords"""

VIEWS["v_coord_atoms"] = """
select distinct sim_id, atom_id,
       case when (sim_id + atom_id) % 4 = 1 and sim_id <> 2 then 'CA' when atom_id % 4 = 2 and sim_id <> 2 then 'N' else 'H' end as name,
       case when atom_id % 5 = 0 then 'SOL' when atom_id % 7 = 1 and sim_id = 0 then 'POPC' else 'ALA' end as resname
from v_traj"""

# Lines of tool reports: one run a page, two lines each.
VIEWS["v_logs"] = """
select page_id as run_id, 1 as line_no, concat('reading ', url) as line from pages
union all
select page_id, 2, case page_id % 5
       when 0 then concat('x', page_id, '.nc is a NetCDF file with coordinates, time, box, Parm time.top (reading 1)')
       when 1 then 'x.nc is a NetCDF file with coordinates, box, Parm a, time, b.top'
       when 2 then 'x.dcd is a DCD file with coordinates, time.'
       when 3 then 'x.xtc opened' else 'x.crd is a file with unit cell' end from pages"""

# Files of a directory: the host of a page is the directory.
VIEWS["v_dir_files"] = """
select concat('/d', page_id % 40, '/s', page_id % 7, case when page_id % 3 = 0 then '_cleaned' else '' end,
              case page_id % 4 when 0 then '.gro' when 1 then '.top' when 2 then '.tpr' else '.psf' end) as path,
       cast(length(url) as bigint) as size, page_id
from pages"""

# Retention of logs: one log per event.
VIEWS["v_log_files"] = """
select concat('/logs/', case when event_id % 6 = 0 then 'cron-' else 'ticket-' end, user_id, '-', event_id,
              case when event_id % 5 = 0 then '.txt' else '.log' end) as path,
       event_id as size, ts as modified_at, user_id as ticket_id, event_id
from events"""

VIEWS["v_snapshots"] = """
select ts, concat('s', event_id) as run_id, event_type <> 'error' as ok
from events"""


# Spark forms of the heavy inputs.  They give the same rows as the plain texts
# above, which stay in use for DuckDB: strings are built after the aggregation,
# so that it works on numbers (hash aggregates, narrow shuffles).  Line items are
# dealt by order before they are aggregated: nearly every key is its own group, so
# an aggregate of a whole scan would only fill memory.
for _name in ("v_landing", "v_ticket", "v_objects"):
    DUCK[_name] = VIEWS[_name]

VIEWS["v_dealt"] = "select /*+ repartition({parts}, l_orderkey) */ * from lineitem"
DUCK["v_dealt"] = "select * from lineitem"
# Line items of a partition of v_dealt.
ROWS_A_PARTITION = 100_000

VIEWS["v_landing"] = """
select ticket_id, part, concat('L', ticket_id, '-', part) as landing_id,
       concat('/z/landing/L', ticket_id, '-', part) as collection,
       partkey, char(linestatus) as linestatus, char(returnflag) as returnflag, discount
from (select l_orderkey as ticket_id, l_linenumber as part, min(l_partkey) as partkey,
             max(ascii(l_linestatus)) as linestatus, min(ascii(l_returnflag)) as returnflag, max(l_discount) as discount
      from v_dealt group by l_orderkey, l_linenumber)"""

VIEWS["v_ticket"] = """
select o.o_orderkey as id, o.o_custkey as created_by_id, o.o_orderdate as created_at,
       case when o.o_orderpriority = '5-LOW' then 'd' else 'u' end as ticket_type,
       o.o_orderstatus = 'F' as upload_notification_sent,
       o.o_orderstatus = 'P' as processing_complete,
       case when parts is not null then array_join(transform(parts, n ->
         case when (o_orderkey + n) % 17 = 0 then concat('bad-L', o_orderkey, '-', n)
              else concat('MDRSubmit_L', o_orderkey, '-', n, ':/z/landing/L', o_orderkey, '-', n) end), ';') end as irods_tickets
from orders o left join (
  select l_orderkey, array_sort(collect_set(l_linenumber)) as parts from v_dealt group by l_orderkey) p
on p.l_orderkey = o.o_orderkey"""

VIEWS["v_objects"] = """
select collection, 'mdrepo-submission.completed.json' as name,
       case when (ticket_id + part) % 11 = 0 then 0 else 5039 end as size,
       md5(landing_id) as md5
from v_landing where (ticket_id * 3 + part) % 13 <> 0
union all
select concat('/z/landing/L', l_orderkey, '-', l_linenumber) as collection,
       concat('part-', l_partkey, '.xtc') as name,
       cast(l_partkey % 1000 + 1 as int) as size,
       md5(concat('f', l_orderkey, '-', l_linenumber, '-', l_partkey)) as md5
from (select distinct l_orderkey, l_linenumber, l_partkey from v_dealt)"""


def closure(text: str, known: dict[str, str]) -> list[str]:
    """Views named in a text and, below them, the ones they need, in order."""
    out: list[str] = []
    open_: set[str] = set()

    def visit(sql: str) -> None:
        for name in re.findall(r"\bv_\w+\b", sql):
            if name in known and name not in out and name not in open_:
                open_.add(name)
                visit(known[name])
                out.append(name)

    visit(text)
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or with a base-table name the table itself, as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return query(spark, sf_dir, f"select * from {name}")


def query(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A SELECT over views and base tables as a DataFrame."""
    views = closure(sql, VIEWS)
    texts = " ".join([sql, *[VIEWS[v] for v in views]])
    tables = [t for t in BASE if re.search(rf"\b(from|join)\s+{t}\b", texts)]
    ctes = [f"{t} as (select * from parquet.`{sf_dir}/{t}.parquet`)" for t in tables]
    ctes += [f"{v} as ({VIEWS[v]})" for v in views]
    if "v_dealt" in views:
        # The footers of the files have the number of rows.
        rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        ctes = [c.replace("{parts}", str(-(-rows // ROWS_A_PARTITION) or 1)) for c in ctes]
    return spark.sql(f"with {', '.join(ctes)} {sql}")


def oracle(sql: str, extra: dict[str, str] | None = None) -> str:
    """The DuckDB text of a query over the views; ``extra`` adds local ones."""
    known = {**VIEWS, **DUCK, **(extra or {})}
    views = closure(sql, known)
    loops = [v for v in views if re.search(rf"\b{v}\b", known[v])]
    # What a recursion reads is computed once, not once a round.
    once = " materialized" if loops else ""
    ctes = [f"{v} as{'' if v in loops else once} ({known[v]})" for v in views]
    head = "with recursive" if loops else "with"
    return f"{head} {', '.join(ctes)} {sql}" if ctes else sql
