"""Standard-SQL equivalents of the registered queries, for an independent engine.

Only the table projections are shared with the Spark side; the operator logic is
written again here, as one list of named subqueries plus a final SELECT per query.
"""

from __future__ import annotations

from casewatch.plans.adapter import LINE_TABLES, ORDER_TABLES, select_list
from casewatch.plans.catalog import KNOWN, NAME_FRAGMENTS, RUN_LABEL, STRICT
from casewatch.schema import CHILDREN, COLUMNS, OUTCOMES, PARTITIONS, ROLES, SEXES, TABLES

FROM = {
    "demo": "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey",
    "rpsr": "orders",
    "outc": "lineitem",
    "ther": "lineitem",
}
WITH_PART = "lineitem join part on l_partkey = p_partkey"


def exact_round(x: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double, as Spark does."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 18)), {digits}) as double)"


def even_round(x: str, digits: int) -> str:
    return f"cast(round_even(cast(cast({x} as varchar) as decimal(38, 18)), {digits}) as double)"


def whole(x: str) -> str:
    return f"try_cast(nullif(regexp_extract(trim({x}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') as integer)"


def day(x: str) -> str:
    parsed = (
        f"cast(case length({x}) when 8 then try_strptime({x}, '%Y%m%d') "
        f"when 6 then try_strptime({x} || '01', '%Y%m%d') "
        f"when 4 then try_strptime({x} || '0101', '%Y%m%d') end as date)"
    )
    return f"case when {parsed} >= date '1900-01-01' and {parsed} <= current_date then {parsed} end"


def texts(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def cols(names: list[str]) -> str:
    return ", ".join(names)


KEYED = "primaryid is not null and primaryid <> ''"
LAST_VERSION = (
    "row_number() over (partition by caseid order by caseversion desc nulls last, "
    "fda_dt desc nulls last, primaryid desc nulls last) = 1"
)
AGE = (
    "case age_cod when 'YR' then age when 'DEC' then age * 10 when 'MON' then age / 12 "
    "when 'WK' then age / 52 when 'DY' then age / 365.25 when 'HR' then age / 8766 end"
)
CLEAN = {
    "drug": {
        "drug_seq": whole("drug_seq"),
        "role_cod": "upper(trim(role_cod))",
        "drugname": "upper(trim(drugname))",
        "prod_ai": "upper(trim(prod_ai))",
        "route": "trim(route)",
        "dose_form": "trim(dose_form)",
        "dose_freq": "trim(dose_freq)",
    },
    "reac": {"pt": "upper(trim(pt))"},
    "outc": {"outc_cod": "upper(trim(outc_cod))"},
    "rpsr": {"rpsr_cod": "upper(trim(rpsr_cod))"},
    "ther": {"dsg_drug_seq": whole("dsg_drug_seq")},
    "indi": {"indi_drug_seq": whole("indi_drug_seq"), "indi_pt": "upper(trim(indi_pt))"},
}
ADDED = {"ther": f", {day('start_dt')} as start_dt_parsed, {day('end_dt')} as end_dt_parsed"}


def _raw(table: str) -> str:
    items = cols([f"{sql} as {name}" for name, sql in select_list(table).items()])
    return f"select {items} from {FROM.get(table, WITH_PART)}"


def _child(table: str, source: str) -> str:
    items = cols([f"{CLEAN[table].get(c, c)} as {c}" for c in COLUMNS[table] + PARTITIONS])
    extra = " and pt is not null and pt <> ''" if table == "reac" else ""
    return f"select {items}{ADDED.get(table, '')} from {source} where {KEYED}{extra}"


def _finished(source: str) -> str:
    return (
        "select primaryid, caseid, caseversion, fda_dt, event_dt, age, age_cod, "
        f"case when sex in {texts(SEXES)} then sex else 'UNK' end as sex, wt, "
        "trim(reporter_country) as reporter_country, trim(occr_country) as occr_country, "
        "trim(mfr_sndr) as mfr_sndr, trim(occp_cod) as occp_cod, _year, _quarter, "
        f"{day('event_dt')} as event_dt_parsed, "
        f"case when {AGE} >= 0 and {AGE} <= 120 then {exact_round(AGE, 1)} end as age_in_years "
        f"from {source}"
    )


def _base_tables() -> list[tuple[str, str]]:
    ctes = [(f"raw_{t}", _raw(t)) for t in TABLES]
    ctes.append(
        (
            "versions",
            f"select * replace ({whole('caseversion')} as caseversion, try_cast(age as double) as age, "
            f"try_cast(wt as double) as wt) from raw_demo where {KEYED}",
        )
    )
    ctes.append(("demo_all", _finished("versions")))
    for suffix, condition in (("", "true"), ("_q1", "_quarter = 'Q1'"), ("_q2", "_quarter = 'Q2'")):
        picked = f"(select * from versions where {condition} qualify {LAST_VERSION})"
        ctes.append((f"demo{suffix}", _finished(picked)))
    for t in CHILDREN:
        ctes.append((t, _child(t, f"raw_{t}")))
        ctes.append((f"stored_q1_{t}", f"select * from {t} where _quarter = 'Q1' and primaryid in (select primaryid from demo_q1)"))
        for suffix, condition in (("", "true"), ("_q1", "_quarter = 'Q1'"), ("_q2", "_quarter = 'Q2'")):
            ctes.append(
                (
                    f"valid_{t}{suffix}",
                    f"select * from {t} where {condition} and primaryid in (select primaryid from demo{suffix})",
                )
            )
    return ctes


def _dirty_tables() -> list[tuple[str, str]]:
    """Uncleaned tables with some keys blanked out, as the dirty quality run has them."""
    blank = "cast(primaryid as bigint) % 100 = 0"
    ctes = [
        (
            "dirty_demo",
            f"select * replace (case when {blank} then '' else primaryid end as primaryid, "
            f"case when not {blank} then caseid end as caseid, "
            f"case when not {blank} then caseversion end as caseversion), age as age_in_years "
            f"from versions qualify {LAST_VERSION}",
        )
    ]
    changed = {
        "drug": " replace (case when dose_amt <> '1' then drugname end as drugname, nullif(primaryid, '1') as primaryid)",
        "reac": " replace (nullif(primaryid, '1') as primaryid)",
    }
    return ctes + [(f"dirty_{t}", f"select *{changed.get(t, '')} from raw_{t}") for t in CHILDREN]


def _merge_tables() -> list[tuple[str, str]]:
    ctes = [
        (
            "actions",
            "select s.*, case when t.caseid is null then 'inserted' "
            "when s.caseversion > t.caseversion then 'updated' else 'unchanged' end as act "
            "from demo_q2 s left join demo_q1 t on s.caseid = t.caseid",
        ),
        (
            "merged",
            "select * from demo_q1 t where not exists "
            "(select 1 from actions a where a.act = 'updated' and a.caseid = t.caseid) "
            "union all select * exclude (act) from actions where act <> 'unchanged'",
        ),
    ]
    for t in CHILDREN:
        ctes.append(
            (
                f"merged_{t}",
                f"select * from (select * from valid_{t}_q1 where primaryid not in "
                f"(select primaryid from valid_{t}_q2 where primaryid in (select primaryid from merged)) "
                f"union all select * from valid_{t}_q2) where primaryid in (select primaryid from merged)",
            )
        )
    return ctes


def _score_tables(tag: str, drug: str, reac: str, prr: float, chi2: float, reports: int):
    return [
        (
            f"pairs{tag}",
            f"select distinct d.primaryid, d.drugname, r.pt from {drug} d join {reac} r "
            "on d.primaryid = r.primaryid where d.role_cod = 'PS'",
        ),
        (
            f"cells{tag}",
            f"select p.drugname, p.pt, p.a, d.n as drug_total, e.n as event_total, "
            "p.a::double as a_, (d.n - p.a)::double as b_, (e.n - p.a)::double as c_, "
            "(t.n - d.n - e.n + p.a)::double as d_, t.n::double as n_ from "
            f"(select drugname, pt, count(distinct primaryid) as a from pairs{tag} group by drugname, pt) p "
            f"join (select drugname, count(distinct primaryid) as n from pairs{tag} group by drugname) d "
            "on p.drugname = d.drugname "
            f"join (select pt, count(distinct primaryid) as n from pairs{tag} group by pt) e on p.pt = e.pt "
            f"cross join (select count(distinct primaryid) as n from pairs{tag}) t",
        ),
        (
            f"half{tag}",
            f"select *, case when a_ = 0 or b_ = 0 or c_ = 0 or d_ = 0 then 0.5 else 0.0 end::double as h from cells{tag}",
        ),
        (
            f"ratios{tag}",
            "select *, ((a_ + h) / ((a_ + h) + (b_ + h))) / ((c_ + h) / ((c_ + h) + (d_ + h))) as prr, "
            "((a_ + h) * (d_ + h)) / ((b_ + h) * (c_ + h)) as ror, "
            "n_ * pow(abs(a_ * d_ - b_ * c_) - n_ / 2, 2) / "
            "nullif((a_ + b_) * (c_ + d_) * (a_ + c_) * (b_ + d_), 0) as chi2, "
            "sqrt(1 / (a_ + h) + 1 / (b_ + h) + 1 / (c_ + h) + 1 / (d_ + h)) as se "
            f"from half{tag}",
        ),
        (
            f"scored{tag}",
            "select *, exp(ln(ror) - 1.96 * se) as lo, exp(ln(ror) + 1.96 * se) as hi, "
            f"prr >= {prr} and chi2 >= {chi2} and a >= {reports} as is_signal from ratios{tag}",
        ),
        (
            f"gold{tag}",
            "select drugname, pt, a::bigint as report_count, b_::bigint as drug_no_event, "
            "c_::bigint as event_no_drug, d_::bigint as neither, "
            f"{exact_round('prr', 4)} as \"PRR\", {exact_round('ror', 4)} as \"ROR\", "
            f"{exact_round('lo', 4)} as \"ROR_95CI_lower\", {exact_round('hi', 4)} as \"ROR_95CI_upper\", "
            f"{exact_round('chi2', 4)} as chi2, is_signal from scored{tag}",
        ),
    ]


def _signal_tables() -> list[tuple[str, str]]:
    return [
        *_score_tables("", "drug", "reac", 2, 4, 3),
        *_score_tables("_strict", "drug", "reac", *STRICT),
        *_score_tables("_merged", "merged_drug", "merged_reac", 2, 4, 3),
        *_score_tables("_latest", "valid_drug", "valid_reac", 2, 4, 3),
        (
            "deaths",
            "select d.drugname, r.pt, count(distinct d.primaryid) as death_reports from drug d "
            "join reac r on d.primaryid = r.primaryid where d.role_cod = 'PS' and d.primaryid in "
            "(select primaryid from outc where outc_cod = 'DE') group by d.drugname, r.pt",
        ),
        (
            "fatal",
            "select s.drugname, s.pt, s.a::bigint as total_reports, coalesce(x.death_reports, 0) as death_reports, "
            f"{exact_round('prr', 2)} as \"PRR\", {exact_round('ror', 2)} as \"ROR\" from scored s "
            "left join deaths x on s.drugname = x.drugname and s.pt = x.pt "
            "where s.is_signal and coalesce(x.death_reports, 0) > 0",
        ),
    ]


def _dq(demo: str, child: str) -> str:
    """The 30-row report on one set of tables; `child` is a name prefix."""

    def blank(c: str) -> str:
        return f"{c} is null or cast({c} as varchar) = ''"

    parts = []

    def nulls(table: str, source: str, column: str, severity: str) -> None:
        parts.append(
            f"select 'null_{column}' as check_name, '{table}' as table_name, "
            f"count(*) filter ({blank(column)}) as n, count(*) as of, 'nulls' as unit, "
            f"'{severity}' as severity from {source}"
        )

    def counted(check: str, table: str, n: str, unit: str, severity: str, source: str) -> None:
        parts.append(
            f"select '{check}', '{table}', {n}, cast(null as bigint), '{unit}', '{severity}' from {source}"
        )

    for c in ("primaryid", "caseid", "caseversion"):
        nulls("DEMO", demo, c, "FAIL")
    for c in ("sex", "age", "event_dt", "reporter_country"):
        nulls("DEMO", demo, c, "BY_SHARE")
    for c in ("primaryid", "drugname", "role_cod"):
        nulls("DRUG", f"{child}drug", c, "FAIL")
    for c in ("primaryid", "pt"):
        nulls("REAC", f"{child}reac", c, "FAIL")
    for table, source, c, domain in (
        ("DEMO", demo, "sex", SEXES),
        ("DRUG", f"{child}drug", "role_cod", ROLES),
        ("OUTC", f"{child}outc", "outc_cod", OUTCOMES),
    ):
        n = f"count(*) filter ({c} is not null and {c} not in {texts(domain)})"
        counted(f"domain_{c}", table, n, "invalid values", "FAIL", source)
    counted(
        "range_age_in_years",
        "DEMO",
        "count(*) filter (age_in_years < 0 or age_in_years > 120)",
        "out of range (0-120)",
        "WARN",
        demo,
    )
    for t in CHILDREN:
        counted(
            f"ref_integrity_{t.upper()}",
            t.upper(),
            "count(*)",
            "orphan primaryids",
            "FAIL",
            f"(select primaryid from {child}{t} except select primaryid from {demo})",
        )
    for key, severity in (("primaryid", "FAIL"), ("caseid", "WARN")):
        n = f"(select count(*) from {demo}) - count(*)"
        source = f"(select distinct {key} from {demo})"
        counted(f"duplicate_{key}", "DEMO", n, f"duplicate {key}s", severity, source)
    for t in ("demo", "drug", "reac", "outc", "ther", "indi"):
        source = demo if t == "demo" else f"{child}{t}"
        counted("row_count", t.upper(), "count(*)", "rows", "PASS", source)

    findings = " union all ".join(parts)
    pct = f"case when of is not null then coalesce({even_round('n / nullif(of, 0) * 100', 2)}, 0.0::double) end"
    return (
        f"select check_name, table_name, format('{{:,}}', n) || ' ' || unit || case when pct is null then '' "
        "else ' (' || case when of = 0 then '0' else cast(pct as varchar) end || '%)' end as metric, "
        "case when severity = 'BY_SHARE' then case when pct = 0 then 'PASS' when pct < 50 then 'WARN' else 'FAIL' end "
        f"when n = 0 then 'PASS' else severity end as result, '{RUN_LABEL}' as run_label, n, pct "
        f"from (select *, {pct} as pct from ({findings}))"
    )


def _post_checks(demo: str, child: str) -> str:
    counts = [
        ("drugname_not_upper", "DRUG", f"select count(*) from {child}drug where drugname <> upper(drugname)"),
        ("drugname_not_trimmed", "DRUG", f"select count(*) from {child}drug where drugname <> trim(drugname)"),
        ("duplicate_primaryid", "DEMO", f"select count(*) - count(distinct primaryid) from {demo}"),
        ("duplicate_caseid", "DEMO", f"select count(*) - count(distinct caseid) from {demo}"),
    ]
    counts += [
        (
            f"ref_integrity_{t.upper()}",
            t.upper(),
            f"select count(*) from (select primaryid from {child}{t} except select primaryid from {demo})",
        )
        for t in CHILDREN
    ]
    rows = " union all ".join(f"select '{c}' as check_name, '{t}' as table_name, ({q}) as n" for c, t, q in counts)
    return f"select *, case when n = 0 then 'PASS' else 'FAIL' end as result from ({rows})"


def _categories(source: str, column: str, n: int | None = None) -> str:
    limit = f" order by count desc, {column} nulls first limit {n}" if n else ""
    return f"select {column}, count(*) as count from {source} group by {column}{limit}"


def _null_rates(source: str, fields: list[str]) -> str:
    def one(c: str) -> str:
        return (
            f"select '{c}' as field, count(*) filter ({c} is null or cast({c} as varchar) = '') as null_count, "
            f"count(*) as total from {source}"
        )

    counted = " union all ".join(map(one, fields))
    pct = even_round("null_count / nullif(total, 0) * 100", 1)
    return f"select field, null_count, coalesce({pct}, 0.0::double) as null_pct from ({counted})"


def _profile(table: str) -> str:
    return (
        f"select '{table.upper()}' as table_name, count(*) as rows, {len(COLUMNS[table])}::integer as data_columns, "
        f"'' as non_string, count(distinct (_year, _quarter)) as partitions from raw_{table}"
    )


def _stored(table: str) -> str:
    """Rows as they come back from text files, where blank text is NULL."""
    items = cols([f"nullif({c}, '') as {c}" for c in COLUMNS[table]] + PARTITIONS)
    return f"select {items} from raw_{table}"


# Data columns of the cleaned tables that are no text, and those that cleaning adds.
TYPED = {
    "demo": (["caseversion", "age", "wt", "event_dt_parsed", "age_in_years"], 2),
    "drug": (["drug_seq"], 0),
    "ther": (["dsg_drug_seq", "start_dt_parsed", "end_dt_parsed"], 2),
    "indi": (["indi_drug_seq"], 0),
}


def _typed_profile(table: str) -> str:
    names, added = TYPED.get(table, ([], 0))
    source = "demo_all" if table == "demo" else table
    return (
        f"select '{table.upper()}' as table_name, count(*) as rows, {len(COLUMNS[table]) + added}::integer as data_columns, "
        f"'{','.join(names)}' as non_string, count(distinct (_year, _quarter)) as partitions from {source}"
    )


def _deltas() -> str:
    rows = ["select 'DEMO' as table_name, (select count(*) from versions) as rows_before, (select count(*) from demo) as rows_after"]
    rows += [
        f"select '{t.upper()}', (select count(*) from {t}), (select count(*) from valid_{t})" for t in CHILDREN
    ]
    return f"select *, rows_before - rows_after as dropped from ({' union all '.join(rows)})"


def _known() -> str:
    values = ", ".join(f"('{d}', '{e}')" for d, e in KNOWN)
    return (
        f"select k.drug, k.event, s.a is not null as found, s.a::bigint as report_count, "
        f"{exact_round('prr', 2)} as \"PRR\", {exact_round('ror', 2)} as \"ROR\", "
        f"{exact_round('chi2', 2)} as chi2, s.is_signal "
        f"from (values {values}) k(drug, event) left join scored s on s.drugname = k.drug and s.pt = k.event"
    )


def _sample_export() -> str:
    ids = "(select primaryid from raw_demo order by primaryid limit 200)"
    return " union all ".join(
        f"select primaryid, count(*) as rows, '{t}' as table_name from raw_{t} "
        f"where primaryid in {ids} group by primaryid"
        for t in ("demo", "drug", "reac")
    )


def _top_signals(order: str, n: int) -> str:
    return (
        "select * from (select drugname, pt, a::bigint as report_count, "
        f"{exact_round('prr', 2)} as \"PRR\", {exact_round('ror', 2)} as \"ROR\", "
        f"{exact_round('lo', 2)} as \"ROR_95CI_lower\", {exact_round('hi', 2)} as \"ROR_95CI_upper\", "
        f"{exact_round('chi2', 2)} as chi2 from scored where is_signal) order by {order} limit {n}"
    )


CASE_VERSIONS = (
    "select caseid, count(distinct caseversion) as num_versions, max(caseversion) as max_version "
    "from versions group by caseid having count(distinct caseversion) > 1"
)
FRAGMENTS = " or ".join(f"contains(upper(drugname), '{f.upper()}')" for f in NAME_FRAGMENTS)


def _overlap(old: str, new: str) -> str:
    return (
        "select count(*) filter (o) as stored_cases, count(*) filter (n) as batch_cases, "
        "count(*) filter (o and n) as in_both, count(*) filter (o and not n) as only_stored, "
        "count(*) filter (n and not o) as only_batch from (select coalesce(x.hit, false) as o, "
        f"coalesce(y.hit, false) as n from (select distinct caseid, true as hit from {old}) x full join "
        f"(select distinct caseid, true as hit from {new}) y on x.caseid = y.caseid)"
    )


def _final_selects() -> dict[str, str]:
    demo_columns = (
        "primaryid, caseid, caseversion, fda_dt, event_dt, age, age_cod, sex, wt, reporter_country, "
        "occr_country, mfr_sndr, occp_cod, _year, _quarter, event_dt_parsed, age_in_years"
    )
    selects = {f"silver_{t}": f"select * from {t}" for t in CHILDREN}
    selects |= {f"merge_child_{t}": f"select * from merged_{t}" for t in CHILDREN if t != "drug"}
    selects |= {f"bronze_rows_{t}": _stored(t) for t in TABLES}
    selects |= {
        "silver_demo": f"select {demo_columns} from demo",
        "valid_children": " union all ".join(
            f"select primaryid, count(*) as rows, '{t}' as table_name from valid_{t} group by primaryid"
            for t in CHILDREN
        ),
        "partition_scan": f"{_stored('drug')} where _year = '2024' and _quarter = 'Q2'",
        "merge_demo": f"select {demo_columns} from merged",
        "merge_demo_stats": (
            "select count(*) as source_rows, count(*) filter (act = 'inserted') as inserted, "
            "count(*) filter (act <> 'inserted') as matched, count(*) filter (act = 'updated') as updated, "
            "count(*) filter (act = 'unchanged') as unchanged from actions"
        ),
        "merge_child": "select * from merged_drug",
        "stored_snapshot_diff": (
            "select (select count(*) from demo_q1) as rows_before, (select count(*) from merged) as rows_after, "
            "(select count(*) from merged) - (select count(*) from demo_q1) as net_new_rows, "
            "(select count(*) from (select caseid from merged except select caseid from demo_q1)) as new_cases, "
            "(select count(*) from (select caseid from demo_q1 except select caseid from merged)) as lost_cases"
        ),
        "stored_row_changes": (
            "select coalesce(b.caseid, a.caseid) as caseid, case when b.caseid is null then 'added' "
            "when a.caseid is null then 'lost' else 'changed' end as change, "
            "(b.caseid is not null)::bigint as rows_before, (a.caseid is not null)::bigint as rows_after "
            f"from (select caseid, row({demo_columns}) as r from demo_q1) b "
            f"full join (select caseid, row({demo_columns}) as r from merged) a on a.caseid = b.caseid "
            "where a.r is distinct from b.r"
        ),
        "stored_demo": f"select {demo_columns} from merged",
        "stored_drug": "select * from merged_drug",
        "contingency_carried_on": "select * from gold_merged",
        "bronze_line_breaks": (
            "select * replace (case when primaryid::bigint % 3 = 0 then concat_ws(chr(10), prod_ai, ' $' || trim(route), '') "
            f"else prod_ai end as prod_ai), true as has_lineage from ({_stored('drug')})"
        ),
        "bronze_second_ingest": (
            f"select *, _quarter = 'Q1' as rewritten from ({_stored('drug')}) "
            "where _quarter <> 'Q1' or primaryid::bigint % 3 <> 0"
        ),
        "merge_child_with_orphans": (
            "select * from valid_drug_q1 where primaryid not in "
            "(select primaryid from valid_drug_q2 where primaryid in (select primaryid from merged)) "
            "union all select * from valid_drug_q2 where primaryid in (select primaryid from merged)"
        ),
        "merge_child_counts": " union all ".join(
            f"select '{t}' as table_name, (select count(*) from valid_{t}_q1) as before, "
            f"(select count(*) from valid_{t}_q2) as batch, (select count(*) from merged_{t}) as after"
            for t in CHILDREN
        ),
        "case_overlap": _overlap("demo_q1", "demo_q2"),
        "snapshot_diff": (
            "select (select count(*) from demo_q1) as rows_before, (select count(*) from merged) as rows_after, "
            "(select count(*) from merged) - (select count(*) from demo_q1) as net_new_rows, "
            "(select count(*) from (select caseid from merged except select caseid from demo_q1)) as new_cases, "
            "(select count(*) from (select caseid from demo_q1 except select caseid from merged)) as lost_cases"
        ),
        "bronze_ingest": " union all ".join(map(_profile, TABLES)),
        "layer_run": f"select *, '{RUN_LABEL}' as _run_label from gold_merged",
        "join_sizes": (
            "select (select count(*) from drug) as drug_rows, "
            "(select count(*) from drug where role_cod = 'PS') as suspect_rows, "
            "(select count(*) from reac) as reaction_rows, "
            "(select count(*) from drug d join reac r on d.primaryid = r.primaryid "
            "where d.role_cod = 'PS') as joined_rows"
        ),
        "drug_event_pairs": "select * from pairs",
        "pair_summary": (
            "select count(*) as pairs, count(distinct drugname) as drugs, count(distinct pt) as events, "
            "count(distinct primaryid) as reports from pairs"
        ),
        "contingency": "select * from gold",
        "contingency_from_pairs": "select * from gold",
        "contingency_latest_cases": "select * from gold_latest",
        "safety_signals": "select * from gold where is_signal",
        "strict_signals": "select * from gold_strict where is_signal",
        "top_signals_by_ror": _top_signals('"ROR" desc, drugname, pt', 30),
        "top_signals_by_reports": (
            'select drugname, pt, report_count, "PRR", "ROR", "ROR_95CI_lower", "ROR_95CI_upper", chi2 '
            "from gold where is_signal order by report_count desc, drugname, pt limit 10"
        ),
        "signals_per_drug": (
            f"select drugname, count(*) as num_signals, {exact_round('max(ror)', 2)} as \"max_ROR\", "
            f"{exact_round('max(prr)', 2)} as \"max_PRR\" from scored where is_signal group by drugname "
            "order by num_signals desc, drugname limit 20"
        ),
        "signal_rate": (
            "select count(*) as pairs, count(*) filter (is_signal) as signals, "
            f"{even_round('count(*) filter (is_signal) / count(*) * 100', 2)} as signal_pct from scored"
        ),
        "death_reports": "select * from deaths",
        "fatal_signals": "select * from fatal",
        "fatal_signals_top": "select * from fatal order by death_reports desc, drugname, pt limit 20",
        "known_pairs": _known(),
        "dq_checks": _dq("demo", "valid_"),
        "dq_checks_unfiltered": _dq("demo_all", ""),
        "dq_checks_dirty": _dq("dirty_demo", "dirty_"),
        "dq_summary": f"select result, count(*) as count from ({_dq('dirty_demo', 'dirty_')}) group by result",
        "dq_failures": f"select * from ({_dq('dirty_demo', 'dirty_')}) where result = 'FAIL'",
        "quality_log": (
            f"select * replace ('Q1' as run_label) from ({_dq('demo_q1', 'stored_q1_')}) "
            f"union all select * from ({_dq('merged', 'merged_')})"
        ),
        "changed_columns": (
            "select 'demo' as table_name, primaryid, "
            "case when _quarter = 'Q1' then occr_country end as occr_country, "
            "case when _quarter = 'Q2' then 'A' || primaryid end as added from merged "
            "union all select 'reac', primaryid, null, case when _quarter = 'Q2' then 'X' end from merged_reac"
        ),
        "drop_orphans_counts": " union all ".join(
            f"select '{t}' as table_name, count(*) as before, "
            f"count(*) filter (primaryid in (select primaryid from demo_q1)) as after, "
            f"count(*) filter (primaryid not in (select primaryid from demo_q1)) as removed "
            f"from {t} where _quarter = 'Q1'"
            for t in CHILDREN
        ),
        "sample_export_text": (
            "select primaryid, nullif(pt, '') as pt from raw_reac "
            "where primaryid in (select primaryid from raw_demo order by primaryid limit 200)"
        ),
        "layer_profile_typed": " union all ".join(_typed_profile(t) for t in TABLES),
        "dq_warnings": f"select * from ({_dq('demo_all', '')}) where result = 'WARN'",
        "post_checks_dirty": _post_checks("dirty_demo", "dirty_"),
        "line_break_counts": (
            "select 'DRUG' as table_name, count(*) filter (primaryid::bigint % 3 = 0) as n from raw_drug "
            "union all select 'REAC', count(*) filter (contains(pt, chr(10))) from raw_reac"
        ),
        "silver_demo_few_columns": (
            "select * exclude (occr_country, mfr_sndr, occp_cod) "
            f"from (select {demo_columns} from demo)"
        ),
        "post_checks": _post_checks("demo", "valid_"),
        "post_checks_unfiltered": _post_checks("demo_all", ""),
        "layer_profile": " union all ".join(map(_profile, TABLES)),
        "layer_deltas": _deltas(),
        "role_counts": _categories("raw_drug", "role_cod"),
        "sex_counts": _categories("raw_demo", "sex"),
        "outcome_counts": _categories("raw_outc", "outc_cod"),
        "country_top": _categories("raw_demo", "reporter_country", 10),
        "reaction_top": _categories("raw_reac", "pt", 20),
        "indication_top": _categories("raw_indi", "indi_pt", 10),
        "case_versions": CASE_VERSIONS,
        "case_versions_top": f"{CASE_VERSIONS} order by num_versions desc, caseid limit 10",
        "case_version_summary": (
            f"select (select count(*) from ({CASE_VERSIONS})) as multi_version_cases, "
            "(select count(distinct caseid) from versions) as cases"
        ),
        "null_rates": _null_rates(
            "demo",
            ["primaryid", "caseid", "event_dt", "age", "age_in_years", "sex", "reporter_country", "occr_country", "wt"],
        ),
        "null_rates_raw": _null_rates(
            "raw_demo",
            ["primaryid", "caseid", "event_dt", "age", "sex", "reporter_country", "occr_country"],
        ),
        "distinct_values": (
            "select 'DRUG' as table_name, 'drugname' as column_name, count(distinct drugname) as distinct_values "
            "from raw_drug union all select 'REAC', 'pt', count(distinct pt) from raw_reac"
        ),
        "merged_sketches": " union all ".join(
            f"select '{t.upper()}' as table_name, '{c}' as column_name, count(*) as rows, count(*) - count({value}) as null_count, "
            f"count(distinct {value}) as distinct_values, true as distinct_within, {within} as median_within from raw_{t}"
            for t, c, value, within in (
                ("demo", "caseid", "caseid", "null::boolean"), ("demo", "age", "try_cast(age as double)", "true"),
                ("drug", "drugname", "drugname", "null::boolean"), ("reac", "pt", "pt", "null::boolean"),
            )
        ),
        "drug_name_search": f"select distinct drugname, prod_ai, role_cod from drug where {FRAGMENTS}",
        "indexed_name_search": f"select distinct drugname, prod_ai, role_cod from drug where {FRAGMENTS}",
        "date_samples": (
            "select distinct event_dt, event_dt_parsed from demo where event_dt is not null "
            "order by length(event_dt), event_dt limit 9"
        ),
        "age_samples": (
            "select age, age_cod, age_in_years from demo where age is not null and age_cod is not null "
            "qualify row_number() over (partition by age_cod order by age) = 1"
        ),
        "demo_samples": (
            "select primaryid, caseid, caseversion, event_dt, age, age_cod, sex, reporter_country, occr_country "
            "from raw_demo order by all limit 10"
        ),
        "suspect_samples": (
            "select primaryid, drugname, prod_ai, route, dose_amt, dose_unit from drug where role_cod = 'PS' "
            "order by all limit 10"
        ),
        "pair_samples": "select primaryid, drugname, pt from pairs order by all limit 15",
        "sample_export_rows": _sample_export(),
    }
    return selects


def oracle_sql() -> dict[str, str]:
    ctes = [*_base_tables(), *_dirty_tables(), *_merge_tables(), *_signal_tables()]
    bodies = dict(ctes)

    def needed(sql: str) -> set[str]:
        words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
        direct = {name for name in bodies if name in words}
        return direct.union(*(needed(bodies[name]) for name in direct)) if direct else direct

    def with_tables(sql: str) -> str:
        used = needed(sql)
        head = ", ".join(f"{name} as ({body})" for name, body in ctes if name in used)
        return f"with {head} {sql}" if head else sql

    return {name: with_tables(sql) for name, sql in _final_selects().items()}
