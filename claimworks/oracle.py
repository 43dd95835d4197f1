"""The same queries as SQL text for a second engine, straight from the order tables."""

from __future__ import annotations

from claimworks.fixtures import CITY_COLUMNS, FACT_COLUMNS


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(f"{text} as {name}" for name, text in expressions.items())


_CTES = {
    "city_dim": f"""
      select {_columns(CITY_COLUMNS)}
      from (select n_nationkey, n_name, unnest([0, 1, 2, 3, 4, 5]) as k from nation)
      where k < 5 or n_nationkey % 5 = 0""",
    "prescriber_fact": f"""
      select {_columns(FACT_COLUMNS)}
      from lineitem join orders on l_orderkey = o_orderkey
      join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "clean_city": """
      select upper(city) as city, state_id, upper(state_name) as state_name,
             upper(county_name) as county_name, population, zips
      from city_dim""",
    "renamed": """
      select npi as presc_id, nppes_provider_last_org_name as presc_lname,
             nppes_provider_first_name as presc_fname, nppes_provider_city as presc_city,
             nppes_provider_state as presc_state, specialty_description as presc_spclt,
             years_of_exp, drug_name, total_claim_count as trx_cnt,
             total_day_supply, total_drug_cost
      from prescriber_fact""",
    "prepared": """
      select presc_id, presc_city, presc_state, presc_spclt,
             try_cast(regexp_extract(years_of_exp, '[0-9]+') as integer) as years_of_exp,
             drug_name, trx_cnt, total_day_supply, total_drug_cost, 'USA' as country_name,
             concat_ws(' ', presc_fname, presc_lname) as presc_fullname
      from renamed where presc_id is not null and drug_name is not null""",
    "clean_presc": """
      select * replace (cast(coalesce(trx_cnt, round(avg(trx_cnt) over (partition by presc_id)))
                             as integer) as trx_cnt)
      from prepared""",
    "zip_counts": """
      select *, cast(len(string_split(zips, ' ')) as integer) as zip_counts from clean_city""",
    "city_prescriber_agg": """
      select presc_state, presc_city, count(distinct presc_id) as presc_counts,
             cast(sum(trx_cnt) as bigint) as trx_counts
      from clean_presc group by presc_state, presc_city""",
    "city_report": """
      select city, state_name, county_name, population, zip_counts, trx_counts, presc_counts
      from zip_counts join city_prescriber_agg on state_id = presc_state and city = presc_city""",
    "in_range": "select * from clean_presc where years_of_exp between 20 and 50",
    "ranked": """
      select *, cast(dense_rank() over (partition by presc_state order by trx_cnt desc nulls last)
                     as integer) as dense_rank
      from in_range""",
    "presc_report": """
      select presc_id, presc_fullname, presc_state, country_name, years_of_exp, trx_cnt,
             total_day_supply, total_drug_cost
      from ranked where dense_rank <= 5""",
    "totals": """
      select presc_id, presc_fullname, presc_state, country_name, years_of_exp,
             cast(sum(trx_cnt) as bigint) as trx_cnt,
             cast(sum(total_day_supply) as bigint) as total_day_supply,
             round(sum(total_drug_cost), 2) as total_drug_cost
      from in_range group by all""",
    "presc_report_total": """
      select * exclude (r)
      from (select *, dense_rank() over (partition by presc_state
                                         order by trx_cnt desc nulls last) as r from totals)
      where r <= 5""",
}

# How each frame follows from the ones before it.
_NEEDS = {
    "city_dim": [],
    "prescriber_fact": [],
    "clean_city": ["city_dim"],
    "renamed": ["prescriber_fact"],
    "prepared": ["renamed"],
    "clean_presc": ["prepared"],
    "zip_counts": ["clean_city"],
    "city_prescriber_agg": ["clean_presc"],
    "city_report": ["zip_counts", "city_prescriber_agg"],
    "in_range": ["clean_presc"],
    "ranked": ["in_range"],
    "presc_report": ["ranked"],
    "totals": ["in_range"],
    "presc_report_total": ["totals"],
}


def _with(names: list[str], select: str) -> str:
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in _NEEDS[name]:
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{name} as ({_CTES[name]})" for name in needed)
    return f"with {ctes}\n{select}"


def _all_of(name: str) -> str:
    return _with([name], f"select * from {name}")


def _counts(frames: dict[str, str], name_column: str = "frame_name") -> str:
    selects = [
        f"select '{label}' as {name_column}, count(*) as row_count from {frame}"
        for label, frame in frames.items()
    ]
    bases = [frame.split()[0] for frame in frames.values()]
    return _with(bases, "\nunion all ".join(selects))


# Column name and Spark type of the cleaned fact (fixed values).
_PROFILED = {
    "presc_id": "bigint",
    "presc_city": "string",
    "presc_state": "string",
    "presc_spclt": "string",
    "years_of_exp": "int",
    "drug_name": "string",
    "trx_cnt": "int",
    "total_day_supply": "int",
    "total_drug_cost": "double",
    "country_name": "string",
    "presc_fullname": "string",
}

_PROFILE = "\nunion all ".join(
    f"select {position} as position, '{name}' as column_name, '{kind}' as data_type, "
    f"count(*) as row_count, count(*) - count({name}) as null_count from clean_presc"
    for position, (name, kind) in enumerate(_PROFILED.items())
)

_SKETCHED = "\nunion all ".join(
    f"select {position} as position, '{name}' as column_name, count(*) as row_count, "
    f"count(*) - count({name}) as null_count, true as distinct_near, true as quantiles_near from clean_presc"
    for position, name in enumerate(_PROFILED)
)
_MERGED = "\nunion all ".join(
    f"select '{name}' as column_name, count(*) as row_count, count(*) - count({name}) as null_count, "
    "true as distinct_near from prepared"
    for name in _PROFILED
)

_REPORT_COLUMNS = {
    "city_report": ["city", "state_name", "county_name", "population", "zip_counts", "trx_counts", "presc_counts"],
    "presc_report": [
        "presc_id", "presc_fullname", "presc_state", "country_name", "years_of_exp", "trx_cnt", "total_day_supply",
        "total_drug_cost",
    ],
}


def _measured(frame: str, where: str = "true") -> str:
    """Number of rows and fingerprint of a report: each value with its length, the sum of 60-bit hashes."""
    texts = [f"coalesce(length({c}::varchar) || ':' || {c}::varchar, 'n')" for c in _REPORT_COLUMNS[frame]]
    hashed = f"('0x' || substr(md5(concat({', '.join(texts)})), 1, 15))::bigint"
    return (
        f"select count(*) as row_count, coalesce(sum({hashed}), 0)::decimal(38, 0) as fingerprint "
        f"from {frame} where {where}"
    )


_SINK_FINGERPRINTS = "\nunion all ".join(
    f"select unnest(['csv', 'parquet', 'run', 'once', 'table']) as sink, '{table}' as table_name, "
    "row_count as written_rows, fingerprint as written_fingerprint, row_count as loaded_rows, "
    f"fingerprint as loaded_fingerprint from ({_measured(frame)})"
    for frame, table in (("city_report", "city_report"), ("presc_report", "prescriber_report"))
)
_RUN_FINGERPRINTS = "\nunion all ".join(
    f"select '{stamp}' as ingested_at, row_count as manifest_rows, fingerprint as manifest_fingerprint, "
    f"row_count, fingerprint from ({_measured('presc_report', where)})"
    for stamp, where in (("2024-01-07", "true"), ("2024-01-14", "presc_state < 'NATION_2'"))
)

_GOOD_LINE = "drug_name is not null and nppes_provider_state is not null"



def _of_good_lines(name: str) -> str:
    """The frame as it is without the lines that the error fixture spoils."""
    fact = f"prescriber_fact as ({_CTES['prescriber_fact']})"
    good = f"prescriber_fact as (select * from all_lines where {_GOOD_LINE})"
    return _all_of(name).replace(fact, f"all_lines as ({_CTES['prescriber_fact']}),\n{good}")


ORACLE_SQL: dict[str, str] = {
    "scan_city_dim": _all_of("city_dim"),
    "scan_presc_csv": _all_of("prescriber_fact"),
    "scan_presc_csv_inferred": _all_of("prescriber_fact"),
    "scan_presc_csv_reordered": _all_of("prescriber_fact"),
    "scan_presc_csv_wide": _all_of("prescriber_fact"),
    "reload_report": _all_of("presc_report"),
    "csv_skip_malformed": _with(
        ["prescriber_fact"], f"select * from prescriber_fact where {_GOOD_LINE}"
    ),
    "csv_line_counts": _counts(
        {
            "good": f"prescriber_fact where {_GOOD_LINE}",
            "malformed": f"prescriber_fact where not ({_GOOD_LINE})",
        },
        "lines",
    ),
    "clean_city": _all_of("clean_city"),
    "presc_select_rename": _all_of("renamed"),
    "presc_add_country": _with(["renamed"], "select *, 'USA' as country_name from renamed"),
    "presc_full_name": _with(
        ["renamed"],
        "select * exclude (presc_fname, presc_lname), "
        "concat_ws(' ', presc_fname, presc_lname) as presc_fullname from renamed",
    ),
    "presc_years_of_exp": _with(
        ["renamed"],
        "select * replace (try_cast(regexp_extract(years_of_exp, '[0-9]+') as integer) "
        "as years_of_exp) from renamed",
    ),
    "presc_drop_null_keys": _with(
        ["renamed"],
        "select * from renamed where presc_id is not null and drug_name is not null",
    ),
    "impute_trx": _with(["clean_presc"], "select presc_id, drug_name, trx_cnt from clean_presc"),
    "clean_presc": _all_of("clean_presc"),
    "zip_counts": _all_of("zip_counts"),
    "zip_counts_udf": _with(["zip_counts"], "select *, true as agrees from zip_counts"),
    "city_prescriber_agg": _all_of("city_prescriber_agg"),
    "city_join": _with(
        ["clean_city", "city_prescriber_agg"],
        "select * from clean_city join city_prescriber_agg "
        "on state_id = presc_state and city = presc_city",
    ),
    "city_report": _all_of("city_report"),
    "city_report_sql": _all_of("city_report"),
    "presc_exp_range": _all_of("in_range"),
    "presc_rank_by_state": _with(
        ["ranked"], "select presc_id, presc_state, drug_name, trx_cnt, dense_rank from ranked"
    ),
    "top5_prescribers": _all_of("presc_report"),
    "top5_prescribers_total": _all_of("presc_report_total"),
    "dq_row_counts": _counts(
        {
            "df_city": "city_dim",
            "df_fact": "prescriber_fact",
            "city_report": "city_report",
            "prescriber_report": "presc_report",
        }
    ),
    "dq_column_profile": _with(["clean_presc"], _PROFILE),
    "dq_column_sketches": _with(["clean_presc"], _SKETCHED),
    "dq_merged_sketches": _with(["prepared"], _MERGED),
    "dq_sink_fingerprints": _with(["city_report", "presc_report"], _SINK_FINGERPRINTS),
    "dq_committed_runs": _with(["presc_report"], _RUN_FINGERPRINTS),
    "sink_committed_runs": _with(
        ["presc_report"],
        "select *, '2024-01-07' as ingested_at from presc_report union all "
        "select *, '2024-01-14' as ingested_at from presc_report where presc_state < 'NATION_2'",
    ),
    "report_tables_pruned": _with(
        ["clean_city", "presc_report"],
        "select * from presc_report where presc_state in (select state_id from clean_city where population < 5000)",
    ),
    "report_tables_reloaded": _with(
        ["presc_report"],
        "select * from presc_report "
        "where presc_state is null or presc_state not in ('NATION_1', 'NATION_2') or trx_cnt >= 49",
    ),
    "csv_quoted_breaks": _with(
        ["prescriber_fact"],
        "select * replace (case npi % 4 when 0 then concat('line' || chr(10) || 'one, ', npi) "
        "when 1 then concat(chr(10), chr(10), npi, chr(10)) when 2 then 'say \"no\"' || chr(10) "
        "else specialty_description end as specialty_description) from prescriber_fact",
    ),
    "dq_loaded_tables": _counts(
        {"prescriber_report": "presc_report", "city_report": "city_report"}, "table_name"
    ),
    "preview_top10": _with(
        ["presc_report"],
        "select * from presc_report order by presc_state nulls first, trx_cnt desc nulls last, "
        "presc_id nulls first, presc_fullname nulls first, country_name nulls first, "
        "years_of_exp nulls first, total_day_supply nulls first, total_drug_cost nulls first limit 10",
    ),
    "sink_city_csv": _all_of("city_report"),
    "sink_presc_csv": _all_of("presc_report_total"),
    "sink_city_parquet": _all_of("city_report"),
    "sink_object_store_run": _with(
        ["city_report"],
        "select *, unnest(['2024-01-07_00-00-00', '2024-01-14_00-00-00']) as ingested_at "
        "from city_report",
    ),
    "sink_create_once": _all_of("city_report"),
    "warehouse_load_rows": _with(
        ["presc_report"],
        "select * replace (nullif(presc_fullname, '') as presc_fullname, "
        "nullif(presc_state, '') as presc_state, nullif(country_name, '') as country_name) "
        "from presc_report",
    ),
    "report_tables_sql": _with(
        ["city_report", "presc_report"],
        """select c.state_name, c.cities, c.claims, p.listed_rows, p.top_claims
        from (select state_name, count(*) as cities, cast(sum(trx_counts) as bigint) as claims
              from city_report group by state_name) c
        join (select upper('State of ' || presc_state) as state_name,
                     count(*) as listed_rows, max(trx_cnt) as top_claims
              from presc_report group by presc_state) p
          on c.state_name = p.state_name""",
    ),
    "whole_job": _counts(
        {
            "df_city": "city_dim",
            "df_fact": "prescriber_fact",
            "city_report": "city_report",
            "prescriber_report": "presc_report",
        }
    )
    + "\nunion all select 'malformed_lines' as frame_name, 0::bigint as row_count",
    "csv_lossless": _with(
        ["city_dim"],
        "select city, state_id, population, [' lead', 'trail ', 'a \"b\" c', 'a,b', 'back\\slash', "
        "'two' || chr(10) || 'lines', '', '\\N', null][(population % 9)::int + 1] as odd from city_dim",
    ),
    "job_city_report": _all_of("city_report"),
    "job_prescriber_report": _all_of("presc_report"),
    "job_with_bad_lines": _of_good_lines("city_report"),
    "job_with_bad_lines_rows": _of_good_lines("presc_report"),
}
