"""Domain views over the given tables, as SQL that both engines read; a few differ and are given twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
_DAY = {"spark": "datediff(cast(l_shipdate as date), date '1992-01-01')", "duckdb": "date_diff('day', date '1992-01-01', cast(l_shipdate as date))"}
_DIV = {"spark": "div", "duckdb": "//"}

#: Rows of files that are no controls.
SAMPLE = "(filename not like '%ExCtrl%' and filename not like '%InjBL%')"

#: name: (what it reads, SQL)
VIEWS = {
    "runs": ((), """
        select f, concat('20240101_JGI_PI_505162_Proj_final_IDX_HILICZ_USX1_POS_MS2_', cast(f as string), '_', sample_name, '_1_Rg_Run', cast(f as string), '.h5') as filename, sample_name
        from (values (0,'groupA'),(1,'groupA'),(2,'groupB'),(3,'groupB'),(4,'groupC'),(5,'ExCtrl'),(6,'InjBL'),(7,'QC')) as t(f, sample_name)"""),
    "run_paths": (("orders",), """
        select concat('/data/', case when o_orderkey % 41 = 0 then concat('odd_', cast(o_orderkey as string), '.h5') else concat('20240101_JGI_PI_', cast(505000 + o_orderkey % 900 as string), '_Proj_final_IDX_',
            case o_orderkey % 3 when 0 then 'HILICZ' when 1 then 'C18-EP' else 'C18' end, '_USX1_', case o_custkey % 3 when 0 then 'POS' when 1 then 'NEG' else 'FPS' end, '_',
            case o_custkey % 2 when 0 then 'MS1' else 'MS2' end, '_', cast(o_custkey as string), '_',
            case o_orderkey % 7 when 0 then 'QC' when 1 then 'ISTD' when 2 then 'ExCtrl' when 3 then 'Blank' when 4 then 'groupA' when 5 then 'groupB' else 'RefStd' end, '_1_',
            case o_custkey % 5 when 0 then 'QC' else 'Rg' end, '_Run', cast(o_orderkey as string), case o_orderkey % 2 when 0 then '.h5' else '.mzML' end) end) as path
        from orders"""),
    "points": (("lineitem", "runs"), """
        select r.filename, m.c, m.mz, m.rt, m.i, m.polarity from (
            select cast(l_suppkey % 8 as int) as f, cast(l_partkey as int) as c,
                   cast((100 + 10 * (l_partkey {D} 2)) * (1 + (l_linenumber - 4) * 2e-6) as float) as mz,
                   cast(1 + (l_partkey % 200) * 0.04e0 + ({DAY} % 201 - 100) / 100.0e0 as float) as rt,
                   cast(l_extendedprice * (case when l_suppkey % 8 in (5, 6) and l_partkey % 3 <> 0 then 0.05e0 else 1e0 end) as float) as i,
                   cast(case when l_returnflag = 'R' then 0 else 1 end as smallint) as polarity
            from lineitem) m join runs r on m.f = r.f"""),
    "atlas": (("part",), """
        select concat('mzrt-', cast(id as string)) as mz_rt_uid, concat('cid-', cast(id {D} 2 as string)) as compound_uid, concat('cmp', cast(id {D} 2 as string)) as compound_name,
               concat('KEY', cast(id {D} 2 as string), '-', cast(id % 2 as string)) as inchi_key, case when id % 2 = 0 then '[M+H]+' else '[M+Na]+' end as adduct,
               cast(100 + 10 * (id {D} 2) as double) as mz, 1 + (id % 200) * 0.04e0 as rt_peak, 0.5e0 + (id % 200) * 0.04e0 as rt_min, 1.5e0 + (id % 200) * 0.04e0 as rt_max, 99 + 10e0 * (id {D} 2) as mono_mass,
               cast(id as int) as place
        from (select p_partkey as id from part) t"""),
    "windows": (("atlas",), """
        select *, cast(mz - mz * 5e0 * 1e-6 as float) as mz_min, cast(mz + mz * 5e0 * 1e-6 as float) as mz_max, cast(rt_min as float) as rt_min_pad, cast(rt_max as float) as rt_max_pad from atlas"""),
    "pairs": (("points", "windows"), """
        select p.filename, p.mz, p.rt, p.i, p.polarity, w.mz_rt_uid, w.compound_name, w.inchi_key, w.adduct, w.mz as atlas_mz, w.rt_peak, w.rt_min, w.rt_max, w.place,
               p.rt between w.rt_min_pad and w.rt_max_pad as in_feature
        from points p join windows w on p.mz between w.mz_min and w.mz_max"""),
    "compounds": (("part",), """
        select concat('KEY', cast(k as string), '-', cast(p_partkey % 2 as string)) as inchi_key, p_name as compound_name,
               case when k % 3 = 0 then '' else concat('C', cast(k as string), 'H', cast(p_partkey % 2 as string)) end as formula, cast(99 + 10 * k as double) as mono_mass
        from (select p_partkey, p_name, 5 * (p_partkey {D} 2) {D} 3 as k from part) t"""),
    "curation": (("atlas", "customer"), """
        select a.mz_rt_uid, a.compound_name, a.inchi_key, a.adduct, a.mz as atlas_mz, a.mono_mass, a.place, case when c.c_custkey % 4 = 0 then 0e0 else a.rt_min end as rt_min, a.rt_max, a.rt_peak,
               case c.c_custkey % 3 when 0 then '' when 1 then 'keep' else 'remove, noise' end as ms1_notes,
               case c.c_custkey % 4 when 0 then '' when 1 then '1.0, good match' when 2 then '0.5, single ion match, no evidence' else '-1.0, poor match, should remove' end as ms2_notes,
               '' as analyst_notes, cast(c.c_acctbal as double) as balance
        from atlas a join customer c on a.place = c.c_custkey"""),
    "ms2_peaks": (("embeddings",), None),
    "scans": (("ms2_peaks",), """
        select scan_id, max(f) as f, max(scan_rt) as scan_rt, max(precursor_mz) as precursor_mz, max(precursor_intensity) as precursor_intensity, max(collision_energy) as collision_energy
        from ms2_peaks group by scan_id"""),
    "ref_peaks": (("ms2_peaks",), "select scan_id as ref_id, ref_key as inchi_key, cast(precursor_mz as double) as ref_precursor_mz, frag_mz as ref_mz, frag_int as ref_int from ms2_peaks"),
    "refs": (("ref_peaks",), "select distinct ref_id, inchi_key, ref_precursor_mz, concat('db', cast(ref_id % 2 as string)) as database, concat('ref', cast(ref_id as string)) as ref_name from ref_peaks"),
    "ms2_pairs": (("scans", "windows", "runs"), """
        select s.scan_id, r.filename, s.scan_rt, s.precursor_mz, s.precursor_intensity, s.collision_energy, w.mz_rt_uid, w.inchi_key, w.rt_min, w.rt_max, s.scan_rt between w.rt_min_pad and w.rt_max_pad as in_feature
        from scans s join windows w on s.precursor_mz between w.mz_min and w.mz_max join runs r on s.f = r.f"""),
    "polar_heights": (("pairs",), "select polarity, mz_rt_uid, filename, max(cast(i as double)) as peak_height from pairs where in_feature group by polarity, mz_rt_uid, filename"),
    "polar_filter": (("polar_heights", "atlas"), f"""
        select k.polarity, a.compound_name, a.mz_rt_uid, a.adduct, a.place, s, case when s is not null and (c is null or s >= 3 * c) then 'keep' else 'remove' end as control_filter
        from (select polarity, mz_rt_uid, max(case when {SAMPLE} then peak_height end) as s, max(case when not {SAMPLE} then peak_height end) as c from polar_heights group by 1, 2) k join atlas a on a.mz_rt_uid = k.mz_rt_uid"""),
    "polar_collapsed": (("polar_heights", "polar_filter"), """
        select f.polarity, f.compound_name, f.control_filter, h.filename, max(h.peak_height) as peak_height
        from polar_heights h join polar_filter f on f.polarity = h.polarity and f.mz_rt_uid = h.mz_rt_uid group by 1, 2, 3, 4"""),
    "polar_union": (("polar_filter", "polar_collapsed"), """
        select c.compound_name, c.mz_rt_uid, c.adduct, case c.polarity when 1 then 'POS' else 'NEG' end as polarity, f.filename, coalesce(h.peak_height, m.low) as peak_height
        from (select polarity, compound_name, control_filter, first(mz_rt_uid order by s desc nulls last, place) as mz_rt_uid, first(adduct order by s desc nulls last, place) as adduct from polar_filter group by 1, 2, 3) c
        join (select distinct polarity, filename from polar_collapsed) f on f.polarity = c.polarity
        join (select polarity, min(peak_height) as low from polar_collapsed group by 1) m on m.polarity = c.polarity
        left join polar_collapsed h on h.polarity = c.polarity and h.compound_name = c.compound_name and h.control_filter = c.control_filter and h.filename = f.filename
        where c.control_filter = 'keep'"""),
    "polar_best": (("polar_union",), f"""
        select * from (select *, row_number() over (partition by compound_name order by top desc nulls last, polarity desc, mz_rt_uid) as n from (
            select compound_name, mz_rt_uid, adduct, polarity, max(case when {SAMPLE} then peak_height end) as top from polar_union group by 1, 2, 3, 4) t) u where n = 1"""),
    "polar_merged": (("polar_union", "polar_best", "part"), """
        select u.*, coalesce(i.ids, '') as cpd_ids from polar_union u join polar_best b on b.compound_name = u.compound_name and b.mz_rt_uid = u.mz_rt_uid and b.adduct = u.adduct and b.polarity = u.polarity
        left join (select concat('cmp', cast(p_partkey {D} 2 as string)) as k, string_agg('cpd' || cast(p_partkey as varchar), ';' order by 'cpd' || cast(p_partkey as varchar)) as ids from part group by 1) i on i.k = u.compound_name"""),
    "metrics": (("pairs",), """
        select mz_rt_uid, filename, max(x) as peak_height, sum((x + px) / 2 * (rt - prt)) as peak_area, max(case when n = 1 then rt end) as rt_peak, max(case when n = 1 then mz end) as mz_peak,
               sum(rt * x) / sum(x) as rt_centroid, sum(mz * x) / sum(x) as mz_centroid
        from (select mz_rt_uid, filename, cast(rt as double) as rt, cast(mz as double) as mz, cast(i as double) as x,
                     lag(cast(i as double)) over (partition by mz_rt_uid, filename order by rt, mz, i) as px, lag(cast(rt as double)) over (partition by mz_rt_uid, filename order by rt, mz, i) as prt,
                     row_number() over (partition by mz_rt_uid, filename order by i desc, rt, mz) as n
              from pairs where in_feature) t group by mz_rt_uid, filename"""),
}
_PEAKS = """select vec_id as scan_id, concat('KEY', cast(label as string), '-', cast(vec_id % 2 as string)) as ref_key, cast(vec_id % 8 as int) as f,
       cast(1 + label * 0.08e0 + (vec_id % 11 - 5) * 0.15e0 as float) as scan_rt, cast(100 + 10 * label as float) as precursor_mz, cast(1000e0 * (vec_id % 50 + 1) as float) as precursor_intensity,
       cast(10e0 * (vec_id % 3 + 1) as float) as collision_energy, cast(50 + 10 * (pos + 1) as float) as frag_mz, cast(v * 1e5 as float) as frag_int from """
_OWN = {
    ("ms2_peaks", "spark"): _PEAKS + "embeddings lateral view posexplode(embedding) p as pos, v where v > 0",
    ("ms2_peaks", "duckdb"): _PEAKS + "(select vec_id, label, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as pos from embeddings) t where v > 0",
}


def text(name: str, engine: str) -> str:
    sql = VIEWS[name][1] or _OWN[name, engine]
    return sql.replace("{D}", _DIV[engine]).replace("{DAY}", _DAY[engine])


#: Tables that are joined and aggregated row by row, with a key to deal them by.
DEALT_BY = {"lineitem": "l_orderkey"}


def spread(table: DataFrame, key: str) -> DataFrame:
    """A table whose files come in fewer splits than there are cores, dealt to all of them; a larger one as it is, without a shuffle."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table


#: Tables of which views make many times the bytes of their files. Spark estimates by the files, and would collect a million targets
#: on the driver to broadcast them; what is known to be small is broadcast by a hint of its own, which goes before this one.
WIDENED = ("part", "customer")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, or a view with all that it reads, as a DataFrame."""
    if name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table = spread(table, DEALT_BY[name]) if name in DEALT_BY else table
        return table.hint("merge") if name in WIDENED else table
    sql = text(name, "spark")
    reads = VIEWS[name][0]
    for r in reads:
        sql = _named(sql, r)
    return spark.sql(sql, **{r: view(spark, sf_dir, r) for r in reads})


def _named(sql: str, name: str) -> str:
    for word in ("from", "join"):
        sql = sql.replace(f"{word} {name} ", f"{word} {{{name}}} ").replace(f"{word} {name}\n", f"{word} {{{name}}}\n")
        if sql.endswith(f"{word} {name}"):
            sql = sql[: -len(name)] + f"{{{name}}}"
        sql = sql.replace(f"{word} {name})", f"{word} {{{name}}})")
    return sql


def with_views(names: str, sql: str) -> str:
    """SQL for the other engine with the named views, and all that they read, as CTEs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in order:
            return
        for r in VIEWS[name][0]:
            add(r)
        order.append(name)

    for n in names.split():
        add(n)
    if not order:
        return sql
    return "with " + ",\n".join(f"{n} as ({text(n, 'duckdb')})" for n in order) + "\n" + sql
