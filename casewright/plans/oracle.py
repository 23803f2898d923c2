"""The registered queries as SQL over the provided tables, written for the checks.

``PARTS`` are named subqueries. A query lists the text that uses them; the subqueries it needs, and the
ones those need, are put in front of it.
"""

from __future__ import annotations

import re

from casewright import fixed_values as fv

AS_OF = "DATE '2001-08-01'"
COUNTRY = "'ASIA'"


# --- text helpers ------------------------------------------------------------------------------------


def number_of_case(cn: str) -> str:
    return f"('N' || lpad(cast(({cn}) % 25 as varchar), 2, '0') || lpad(cast({cn} as varchar), 7, '0'))"


def cid(cif: str) -> str:
    return f"left(replace({cif}, '.', ''), length(replace({cif}, '.', '')) - 1)"


def sid(cif: str, pb: str) -> str:
    return f"({cid(cif)} || '.PB' || cast(coalesce({pb}, 0) as varchar))"


def case_of(sus: str) -> str:
    return f"regexp_replace({sus}, '\\.?PB[0-9]+$', '')"


def first_rows(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (f"select {columns} from (select *, row_number() over (partition by {keys} order by {order}) as rn_ "
            f"from {source}) where rn_ = 1")


def flag(i: int, name: str) -> str:
    if name == "exploitation_organ_removal_occ":
        return f"false as {name}"
    return (f"case when (o_orderkey + {i}) % 41 = 0 then null "
            f"else (o_orderkey * {2 * i + 3} + {i * i}) % 97 < {20 + 10 * (i % 5)} end as {name}")


def pick(values: list[str], index: str) -> str:
    cells = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"(case {index} {cells} end)"


FLAGS = ", ".join(fv.CASE_FORM_FLAGS)
STATUSES = ["", fv.SUSPECT_LOCATED_STATUS, fv.VICTIM_WILLING_STATUS, "In progress"]
FORM_COLUMNS = ("cif_number, interview_date, number_of_victims, case_notes, number_of_traffickers, "
                f"{FLAGS}, expected_earning, planned_destination, legal_action_taken, "
                "total_blue_flags, station_id")
CONTACTS = "full_name, phone_contact, address_notes, case_filed_against, social_media"


def narrative_sql() -> str:
    def when(rule):
        return f"case when {rule[0]} then '{rule[1]}' else '' end"

    def last_of(rules):
        cases = " ".join(f"when {c} then '{s}'" for c, s in reversed(rules))
        return f"case {cases} else '' end"

    belief = [(f"contains(pv_believes, '{w}')", s) for w, s in fv.NARRATIVE_BELIEF]
    parts = [
        when(fv.NARRATIVE_BROKER),
        *[when(r) for r in fv.NARRATIVE_RECRUITED[::-1]],
        *[when(r) for r in fv.NARRATIVE_TRAVEL],
        f"case when expected_earning <> '' then '{fv.NARRATIVE_EARNING[0]}' || expected_earning || '{fv.NARRATIVE_EARNING[1]}' else '' end",
        last_of(fv.NARRATIVE_PURPOSE),
        f"case when planned_destination <> '' then '{fv.NARRATIVE_DESTINATION[0]}' || planned_destination || '{fv.NARRATIVE_DESTINATION[1]}' else '' end",
        last_of(fv.NARRATIVE_ID),
        f"case when contains(legal_action_taken, '{fv.NARRATIVE_LEGAL[0]}') then '{fv.NARRATIVE_LEGAL[1]}' else '' end",
        last_of(belief),
    ]
    return " || ".join(parts)


def destination_sql(places, unknown: bool, column: str = "planned_destination") -> str:
    clean = f"regexp_replace({column}, '[^\\w\\s]+', '', 'g')"
    out = [f"coalesce(regexp_matches({clean}, '{'|'.join(fv.GULF_WORDS)}'), false) as destination_gulf"]
    if unknown:
        out.append(f"coalesce(contains({clean}, '{fv.UNKNOWN_DESTINATION_WORD}'), false) as destination_unknown")
    out += [f"coalesce(contains({clean}, '{p}'), false) as destination_{p}" for p in places]
    return ", ".join(out)


BELIEFS = ", ".join(f"coalesce(contains(pv_believes, '{w}'), false) as {c}" for c, w in fv.BELIEF_WORDS)
DIGITS = "coalesce(try_cast(regexp_replace(expected_earning, '[^0-9]', '', 'g') as double), 0)"
EXPLOITATION = " + ".join(
    f"(case when {c} then {w}::double else 0::double end)" for c, w in fv.EXPLOITATION_WEIGHTS.items())
BELIEF_WEIGHT = "(case " + " ".join(
    f"when contains(pv_believes, '{word}') then {fv.BELIEF_WEIGHTS[c]}::double" for c, word in fv.BELIEF_WORDS) + " else 0::double end)"


def box_hit(c: str) -> str:
    return (f"coalesce(list_contains(string_split(regexp_replace({c}, '[^0-9]+', ',', 'g'), ','), "
            f"cast(pb_number as varchar)), false) as {c}2")


def wide_arrests() -> str:
    cells = []
    for n in range(1, 8):
        at = f"case when l_linenumber = {n} then"
        cells += [
            f"coalesce(max({at} 'Supplier-' || l_suppkey || '-' || l_linenumber end), '') as pb{n}_name",
            f"coalesce(max({at} (case when l_returnflag = 'R' then 'Yes' else 'No' end) end), '') as pb{n}_arrested",
            f"coalesce(max({at} strftime(l_shipdate, '%m/%d/%Y') end), '') as pb{n}_arrest_date",
        ]
    return ", ".join(cells)


def long_arrests() -> str:
    return " union all ".join(
        f"select irf_number as case_id, pb{n}_name as name, pb{n}_arrested as arrested, "
        f"pb{n}_arrest_date as arrest_date, irf_number || '.PB{n}' as suspect_id "
        f"from arrests_sheet where coalesce(try_cast(outcome_arrest as double), 0) = 1 and contains(pb{n}_arrested, 'Yes')"
        for n in range(1, 8))


def sheet_columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in columns.items())


SUSPECT_CELLS = sheet_columns({
    "case_id": "case_id", "case_name": "'Case ' || cn", "suspect_id": "suspect_id",
    "name": "'Sheet suspect ' || cn || '-' || pb",
    "narrative": "'kept ' || cn",
    "case_status": pick(STATUSES, "(cn + pb) % 4"),
    "eminence": pick(["", "1", "5", "9", "12"], "(cn * 3 + pb) % 5"),
    "bio_and_location": "case when pb % 2 = 0 then 'known' else '' end",
    "relationships": "case when cn % 3 = 0 then 'rel/' || suspect_id else '' end",
    "date_relationships_updated": pick(["07/31/2001", "08/01/2001", "06/01/2001", ""], "cn % 4"),
    "date_closed": "case when cn % 17 = 0 then '07/01/2001' else '' end", "irf_case_notes": "''",
})
POLICE_CELLS = sheet_columns({
    "case_id": "case_id", "case_name": "'Case ' || cn", "suspect_id": "suspect_id",
    "suspect_name": "'Sheet suspect ' || cn || '-' || pb", "narrative": "'police ' || cn",
    "case_status": pick(STATUSES, "(cn + 2 * pb) % 4"),
    "date_closed": "case when cn % 19 = 0 then '07/02/2001' else '' end",
})
VICTIM_CELLS = sheet_columns({
    "case_id": "case_id", "case_name": "'Case ' || cn",
    "victim_id": "case_id || '.V' || (1 + k % 3)", "name": "'Sheet victim ' || k",
    "case_status": pick(STATUSES, "(cn // 3 + (k % 3) // 2) % 4"),
    "date_closed": "case when k % 23 = 0 then '07/03/2001' else '' end",
})

# Where each group's new rows, sheet and closed rows are, and which columns the lifecycle checks look at.
ENTITIES = {
    "suspects": ("suspect_id", "name", "suspects_new", "suspects_sheet", "suspects_closed"),
    "police": ("suspect_id", "suspect_name", "police_new", "police_sheet", "police_closed"),
    "victims": ("victim_id", "name", "victims_new", "victims_sheet", "victims_closed"),
}


def lifecycle_parts() -> dict[str, str]:
    out = {"police_new": "select * rename (name as suspect_name) from suspects_new"}
    for g, (uid, name, new, sheet, closed) in ENTITIES.items():
        out[f"{g}_combined"] = (
            f"select {uid} as uid, case_id, {name} as name, case_status, date_closed from {sheet} union all "
            f"select {uid}, case_id, {name}, null, null from {new} where {uid} not in (select {uid} from {sheet})")
        arrested = "" if g == "victims" else (
            f" union all select 1, {uid}, case_id, {name}, '{fv.ALREADY_ARRESTED_STATUS}', null from {new} "
            f"where {uid} in (select suspect_id from arrested_ids)")
        out[f"{g}_all_closed"] = (
            f"select 0 as t, {uid} as uid, case_id, {name} as name, case_status, date_closed from {closed}{arrested} "
            f"union all select 2, {uid}, case_id, {name}, case_status, date_closed from {sheet} where length(date_closed) > 1")
        out[f"{g}_closed2"] = first_rows(f"{g}_all_closed", "uid", "t", "uid, case_id, name, case_status, date_closed")
        out[f"{g}_active2"] = (f"select uid, case_id, name, case_status, date_closed from {g}_combined "
                               f"where uid not in (select uid from {g}_closed2)")
    missing = "case_id not in (select case_id from {}_active2)"
    closes = {
        "suspects": f"uid in (select uid from police_closed2) or {missing.format('victims')}",
        "police": f"uid in (select uid from suspects_closed2) or {missing.format('victims')}",
        "victims": f"{missing.format('police')} or {missing.format('suspects')}",
    }
    for g, condition in closes.items():
        out[f"{g}_closed3"] = (f"select * from {g}_closed2 union all select * from {g}_active2 where ({condition}) "
                               f"and uid not in (select uid from {g}_closed2)")
        out[f"{g}_active3"] = f"select * from {g}_active2 where not ({condition})"
    return out


def md5_number(keys_text: str, order: str, start: str = "0") -> str:
    return f"cast({start} + row_number() over (order by left(md5({keys_text}), 3), {order}) as bigint)"


TWO_KEYS = "{a} || chr(1) || coalesce(cast({b} as varchar), '')"


def graph_parts(prefix: str, links: str) -> dict[str, str]:
    p = prefix
    text = TWO_KEYS.format(a="account_name", b="suspect_id")
    edge_text = TWO_KEYS.format(a="cast(source_account_id as varchar)", b="target_account_id")
    return {
        f"{p}suspects": f"select {md5_number('name', 'name')} as id, name from (select distinct name from {links})",
        f"{p}cases": f"select {md5_number('case_number', 'case_number')} as id, case_number "
                     f"from (select distinct case_id as case_number from {links})",
        f"{p}labels": f"select target as account_name, arg_min(target_label, row_no) as account_label from {links} group by target",
        f"{p}sources": f"select distinct l.source as account_name, s.id as suspect_id from {links} l join {p}suspects s on l.name = s.name",
        f"{p}account_rows": f"select s.account_name, s.suspect_id, t.account_label from {p}sources s left join {p}labels t "
                            f"on s.account_name = t.account_name union all select account_name, null, account_label from {p}labels "
                            f"where account_name not in (select account_name from {p}sources)",
        f"{p}accounts": f"select {md5_number(text, 'account_name, suspect_id')} as id, account_name, account_label, "
                        f"(case when contains(account_name, 'facebook') then 1 else 2 end)::int as account_type_id, suspect_id from {p}account_rows",
        f"{p}account_ids": f"select account_name, min(id) as account_id from {p}accounts group by account_name",
        f"{p}first_links": first_rows(links, "source, target", "row_no"),
        f"{p}edge_rows": edge_rows_sql(f"{p}first_links", f"{p}suspects", f"{p}account_ids"),
        f"{p}edges": f"select {md5_number(edge_text, 'source_account_id, target_account_id')} as id, * from {p}edge_rows",
        f"{p}case_suspect_rows": case_suspect_sql(links, f"{p}suspects", f"{p}cases"),
        f"{p}case_suspects": f"select {md5_number('cast(suspect_id as varchar)', 'suspect_id')} as id, * from {p}case_suspect_rows",
    }


def edge_rows_sql(first_links: str, suspects: str, account_ids: str, also: str = "") -> str:
    types = " ".join(f"when '{name}' then {i}" for i, name, _ in fv.EDGE_TYPES)
    combo = ("a.account_id || (case l.edge_direction when 1 then '<->' when 2 then '->' else '<-' end) || b.account_id")
    return (f"select s.id as source_suspect_id, a.account_id as source_account_id, b.account_id as target_account_id, "
            f"(case l.relationship_type {types} end)::int as edge_type_id, l.edge_direction, {combo} as edge_combo_id{', ' + also if also else ''} "
            f"from {first_links} l left join {suspects} s on l.name = s.name "
            f"left join {account_ids} a on a.account_name = l.source left join {account_ids} b on b.account_name = l.target")


def case_suspect_sql(links: str, suspects: str, cases: str) -> str:
    return (f"select c.id as case_id, s.id as suspect_id, f.suspect_case_id from "
            f"({first_rows(links, 'name', 'row_no')}) f join {suspects} s on f.name = s.name "
            f"left join {cases} c on c.case_number = f.case_id")


def incremental_parts() -> dict[str, str]:
    def start(table):
        return f"(select coalesce(max(id), 0) from {table})"

    account_text = "account_name"
    return {
        "local_links": f"select * from links where left(case_id, 3) in (select station_code from station_key where country_name = {COUNTRY})",
        **graph_parts("k_", "local_links"),
        "i_suspects": f"select {md5_number('name', 'name', start('k_suspects'))} as id, name from "
                      "(select distinct name from links where name not in (select name from k_suspects))",
        "i_cases": f"select {md5_number('case_number', 'case_number', start('k_cases'))} as id, case_number from "
                   "(select distinct case_id as case_number from links where case_id not in (select case_number from k_cases))",
        "x_suspects": "select id, name from k_suspects union all select id, name from i_suspects",
        "x_cases": "select id, case_number from k_cases union all select id, case_number from i_cases",
        "i_case_suspect_rows": case_suspect_sql("links", "x_suspects", "x_cases"),
        "i_case_suspects": f"select {md5_number('cast(suspect_id as varchar)', 'suspect_id', start('k_case_suspects'))} as id, * "
                           "from i_case_suspect_rows where suspect_id not in (select suspect_id from k_case_suspects)",
        "i_labels": "select target as account_name, arg_min(target_label, row_no) as account_label from links group by target",
        "i_sources": "select f.source as account_name, '' as account_label, s.id as suspect_id from "
                     f"({first_rows('links', 'source', 'row_no')}) f left join x_suspects s on f.name = s.name",
        "i_account_rows": "select * from i_sources union all select account_name, account_label, null from i_labels "
                          "where account_name not in (select account_name from i_sources)",
        "i_accounts": f"select {md5_number(account_text, 'account_name', start('k_accounts'))} as id, account_name, account_label, "
                      "(case when contains(account_name, 'facebook') then 1 else 2 end)::int as account_type_id, suspect_id "
                      "from i_account_rows where account_name not in (select account_name from k_accounts)",
        "x_account_ids": "select account_name, min(id) as account_id from (select id, account_name from k_accounts "
                         "union all select id, account_name from i_accounts) group by account_name",
        "i_first_links": first_rows("links", "sheet_id, source, target", "row_no"),
        "i_edge_rows": edge_rows_sql("i_first_links", "x_suspects", "x_account_ids", "l.row_no"),
        "i_edge_first": first_rows("i_edge_rows", "edge_combo_id", "row_no", "* exclude (rn_, row_no)"),
        "i_edges": f"select {md5_number('edge_combo_id', 'edge_combo_id', start('k_edges'))} as id, * from i_edge_first "
                   "where edge_combo_id not in (select edge_combo_id from k_edges)",
    }


def case_links_sql(end: str, column: str) -> str:
    """Other cases per suspect by matching pairs directly."""
    return (f"select e.source_suspect_id as suspect_id, count(distinct o.case_number) as {column} "
            f"from g_edges e join g_edge_cases o on o.{end} = e.source_account_id "
            f"left join g_suspect_case own on own.suspect_id = e.source_suspect_id and own.case_number = o.case_number "
            f"where own.suspect_id is null group by 1")


SOLVABILITY_TERMS = [
    ("coalesce(willing_score, 0)", "Victim_Willing_to_Testify"),
    ("bio_known", "Bio_and_Location_of_Suspect"),
    ("coalesce(others_arrested, 0)", "Other_Suspect(s)_Arrested"),
    ("coalesce(willing_to_arrest, 0)", "Police_Willing_to_Arrest"),
    ("coalesce(recency_score, 0)", "Recency_of_Case"),
    ("coalesce(belief_score, 0)", "PV_Believes"),
    ("coalesce(exploitation_score, 0)", "Exploitation_Reported"),
]


def solvability_sql(weights: dict[str, float]) -> str:
    terms = " + ".join(f"({sql}) * {float(weights[k])}::double" for sql, k in SOLVABILITY_TERMS)
    return f"(({terms}) / {float(sum(weights.values()))}::double)"


def priority_sql(eminence: str) -> str:
    w = fv.PRIORITY_WEIGHTS
    return (f"coalesce(round(solvability * {w['Solvability']}::double + strength_of_case * {w['Strength_of_Case']}::double "
            f"+ {eminence} * 0.1::double * {w['Eminence']}::double, 3), 0::double)")


def willing_sql(condition: str) -> str:
    return (f"select case_id, count(*) as willing_count, string_agg(name, ', ' order by name) as willing_to_testify "
            f"from victims_sheet where {condition} group by case_id")


WILLING = f"case_status = '{fv.VICTIM_WILLING_STATUS}'"
STEP = f"contains(case_status, '{fv.STEP_COMPLETE}')"
MULTIPLIER = "(case when coalesce(willing_count, 0) >= 7 then 1::double else 1 - pow(0.5::double, coalesce(willing_count, 0)) end)"
# Values in the order of the stored vocabulary: by feature (a feature a day), then by digest bucket and value.
VOCABULARY = f"""
    select feature, value, row_number() over (
             order by feature, left(md5(feature || chr(1) || coalesce(value, '')), 3), value nulls first) as id,
           cast({AS_OF} + day as date) as first_seen
    from (select distinct 'education' as feature, cast(education as varchar) as value, 0 as day from case_form
          union all select distinct 'pv_occupation', cast(pv_occupation as varchar), 1 from case_form)"""
AGE = f"cast(date_diff('day', interview_date, {AS_OF}) as double)"
BIO = f"(case when case_status = '{fv.SUSPECT_LOCATED_STATUS}' then 1 else 0 end)::int"
DAMPING = f"log10(first_degree_links + {fv.NETWORK_LINK_OFFSET})"
TYPED_EMINENCE = "(case when eminence is null or trim(eminence) = '' then 1::double else try_cast(eminence as double) end)"
LIFTED_EMINENCE = f"coalesce(case when {TYPED_EMINENCE} + network_weight > 9 then 9::double else {TYPED_EMINENCE} + network_weight end, 0::double)"

PARTS = {
    "country": "select r_regionkey as id, r_name as name from region",
    "station": "select n_nationkey as id, n_name as station_name, n_regionkey as operating_country_id from nation",
    "station_key": "select 'N' || lpad(cast(s.id as varchar), 2, '0') as station_code, c.name as country_name "
                   "from station s join country c on s.operating_country_id = c.id",
    "case_form": f"""
        select o_orderkey as id,
          {number_of_case('o_orderkey // 3')} || case when o_orderkey % 3 = 0 and (o_orderkey // 3) % 5 = 0 then '.1'
            when o_orderkey % 3 = 0 then 'A' when o_orderkey % 3 = 1 then 'B' else 'C' end as cif_number,
          cast(o_orderdate as date) as interview_date, cast((o_orderkey // 3) % 25 as int) as station_id,
          o_custkey as main_pv_id,
          case when o_orderkey % 11 = 0 then null else cast(1 + o_orderkey % 5 as int) end as number_of_victims,
          cast(1 + o_orderkey % 4 as int) as number_of_traffickers,
          cast(floor(o_totalprice / 100000) as int) as total_blue_flags,
          case when o_orderkey % 4 <> 0 then '' when o_orderkey % 28 = 0 then 'nan' else 'note ' || o_orderkey end as case_notes,
          case when o_orderkey % 13 = 0 then null when o_orderkey % 3 = 0 then ''
            else cast(floor(o_totalprice) as bigint) || ' USD' end as expected_earning,
          case o_orderpriority when '1-URGENT' then 'Kampala, city' when '2-HIGH' then 'Dubai (UAE)'
            when '3-MEDIUM' then 'Nairobi/Kenya' when '4-NOT SPECIFIED' then 'Does not know' else '' end as planned_destination,
          case o_orderstatus when 'F' then 'yes, filed' when 'O' then 'no' end as legal_action_taken,
          {', '.join(flag(i, n) for i, n in enumerate(fv.CASE_FORM_FLAGS))},
          case o_orderkey % 5 when 0 then 'Primary' when 1 then 'Secondary' when 2 then 'None/Illiterate'
            when 4 then 'University' end as education,
          case o_orderkey % 3 when 0 then 'Farmer' when 1 then 'Trader' end as pv_occupation,
          cast(o_orderkey % 4 as int) as known_broker_years,
          case when o_orderkey % 6 = 0 then null else (1 + o_orderkey % 7) || ',' || (1 + (o_orderkey // 7) % 7) end as recruited_broker_pb,
          case when o_orderkey % 5 = 0 then '' else cast(1 + o_orderkey % 12 as varchar) end as how_recruited_broker_online_pb,
          cast(o_custkey as varchar) as pv_contact, o_orderpriority as staff_lb_note, o_orderstatus as guardian_name
        from orders""",
    "boxes": first_rows("lineitem", "l_orderkey, l_linenumber", "l_suppkey, l_partkey, l_shipdate, l_quantity, l_extendedprice"),
    "person_box": """
        select l_orderkey as cif_id, l_orderkey * 10 + l_linenumber as person_id,
          case when l_partkey % 29 = 0 then null when l_partkey % 31 = 0 then l_linenumber + 9 else l_linenumber end as pb_number
        from boxes""",
    "person": """
        select l_orderkey * 10 + l_linenumber as id, s_name || '-' || l_linenumber as full_name,
          case when l_partkey % 17 = 0 then null else '07' || lpad(cast(l_suppkey as varchar), 8, '0') end as phone_contact,
          case l_suppkey % 5 when 0 then 'Plot ' || l_partkey || ' Kampala' when 1 then 'Nairobi West' when 2 then ''
            when 3 then 'Border road' end as address_notes,
          case when l_partkey % 3 = 0 then 'yes' else '' end as case_filed_against,
          case when l_partkey % 2 = 0 then 'fb' || l_suppkey else '' end as social_media,
          case when l_returnflag = 'R' then 'Yes' else 'No' end as arrested,
          case l_partkey % 5 when 0 then 'Definitely trafficked many' when 1 then 'Has trafficked some'
            when 2 then 'Suspect trafficker' when 3 then 'Don''t believe' end as pv_believes,
          case l_suppkey % 6 when 0 then 'Broker' when 1 then 'Witness' when 2 then 'Complainant' when 3 then 'Companion'
            when 4 then 'Host' end as role,
          cast(l_suppkey % 25 as int) as address1_id,
          case when l_partkey % 19 = 0 then null else l_suppkey end as address2_id
        from boxes join supplier on l_suppkey = s_suppkey""",
    "pv_person": """
        select c_custkey as id, case when c_custkey % 13 = 0 then '' else c_name end as full_name,
          '08' || lpad(cast(c_custkey as varchar), 8, '0') as phone_contact,
          case when c_custkey % 4 = 0 then '' else 'House ' || c_custkey end as address_notes,
          case when c_custkey % 2 = 0 then '' else 'pv' || c_custkey end as social_media,
          c_nationkey as address1_id, case when c_custkey % 19 = 0 then null else c_custkey % 97 end as address2_id
        from customer""",
    "incident_notes": f"select {number_of_case('o_orderkey // 3')} as irf_number, 'incident ' || o_orderkey as case_notes "
                      "from orders where o_orderkey % 3 = 0 or o_orderkey % 9 = 1",
    "addresses": "select n_nationkey as address1_id, n_name as address_1, s_suppkey as address2_id, "
                 "'Area ' || s_suppkey as address_2 from nation join supplier on s_nationkey = n_nationkey",
    "sus_keys": f"select distinct cif_id // 3 as cn, pb_number as pb, {number_of_case('cif_id // 3')} as case_id, "
                f"{number_of_case('cif_id // 3')} || '.PB' || pb_number as suspect_id from person_box where pb_number is not null",
    "suspects_sheet": f"select {SUSPECT_CELLS} from sus_keys where cn % 10 <= 3",
    "suspects_closed": f"select {SUSPECT_CELLS} from sus_keys where cn % 10 = 4",
    "police_sheet": f"select {POLICE_CELLS} from sus_keys where cn % 10 <= 2",
    "police_closed": f"select {POLICE_CELLS} from sus_keys where cn % 10 = 4 or (cn % 10 = 3 and pb = 1)",
    "victim_keys": f"select o_orderkey as k, o_orderkey // 3 as cn, {number_of_case('o_orderkey // 3')} as case_id from orders",
    "victims_sheet": f"select {VICTIM_CELLS} from victim_keys where cn % 10 <= 3",
    "victims_closed": f"select {VICTIM_CELLS} from victim_keys where cn % 10 = 4",
    "cases_sheet": f"select {number_of_case('o_orderkey // 3')} as case_id, case when o_orderkey % 15 = 0 then '' "
                   "else 'Name ' || o_orderkey end as case_name from orders where o_orderkey % 3 = 0 or o_orderkey % 12 = 1",
    "arrests_sheet": f"""
        select {number_of_case('o_orderkey // 3')} as irf_number,
          case when o_orderkey % 7 = 0 then '' when o_orderstatus = 'F' then '1' else '0' end as outcome_arrest, w.*
        from orders join (select l_orderkey, {wide_arrests()} from boxes group by l_orderkey) w on l_orderkey = o_orderkey""",
    "arrest_long": long_arrests(),
    "arrests": "select *, count(*) over (partition by case_id) as total_arrests, 1 as arrest from arrest_long",
    "event_rows": "select *, user_id // 3 as cn, (user_id * 31 + event_id) % 300 as t, "
                  "event_id = min(event_id) over (partition by user_id) as is_first from events",
    "link_rows": f"""
        select user_id as sheet_id, event_id as row_no, case when is_first then 'Suspect ' || user_id else '' end as name,
          case event_type when 'view' then 'Facebook Friend' when 'click' then 'Facebook Like' when 'signup' then 'Phone Contact'
            when 'purchase' then 'Phone Call' else 'SMS' end as relationship_type,
          case when event_type in ('view', 'click') then 'facebook.com/u' || (user_id // 2) else '07' || ((user_id + 1) // 2) end as source,
          case when event_id % 3 = 0 then 'facebook.com/u1' when t % 2 = 0 then 'facebook.com/u' || t else '07' || t end as target,
          case when event_id % 4 = 0 then '' else 'Label ' || (event_id % 50) end as target_label,
          case when is_first then {number_of_case('cn')} else '' end as case_id,
          case when is_first then {number_of_case('cn')} || '.PB' || (1 + user_id % 3) else '' end as suspect_case_id
        from event_rows""",
    "sheet_heads": "select sheet_id, arg_min(name, row_no) as name, arg_min(case_id, row_no) as case_id, "
                   "arg_min(suspect_case_id, row_no) as suspect_case_id from link_rows group by sheet_id",
    "links": """
        select l.sheet_id, l.row_no, h.name, l.relationship_type, l.source, l.target, l.target_label, h.case_id, h.suspect_case_id,
          (case when contains(l.relationship_type, 'Friend') then 1 when contains(l.relationship_type, 'Like') then 3 else 2 end)::int as edge_direction
        from link_rows l join sheet_heads h on l.sheet_id = h.sheet_id""",
    "soc_scores": f"""
        select {number_of_case('cif_id // 3')} || '.PB' || pb_number as suspect_id, cif_number, interview_date,
          (cif_id * 37 + pb_number * 11) % 997 / 997.0::double as soc
        from case_form f join person_box b on f.id = b.cif_id where pb_number is not null""",
    "country_stations": f"select s.id, s.station_name from station s join country c on s.operating_country_id = c.id where c.name = {COUNTRY}",
    "scan": f"""
        select {FORM_COLUMNS}, cif_id, person_id, pb_number, arrested, pv_believes, role, station_name, {CONTACTS}
        from case_form f join person_box b on f.id = b.cif_id join person p on p.id = b.person_id
        join country_stations s on s.id = f.station_id""",
    "scan_all": "select f.*, b.* from case_form f join person_box b on f.id = b.cif_id",
    "sus_forms": f"select *, {sid('cif_number', 'pb_number')} as suspect_id, (case when arrested = 'Yes' then 1 else 0 end)::int as arrest "
                 "from scan where coalesce(role, '') not in ('Complainant', 'Witness') and pb_number is not null",
    "noted": f"select * replace (case when case_notes = '' then {narrative_sql()} when case_notes = 'nan' or case_notes is null then '' "
             "else case_notes end as case_notes) from sus_forms",
    "victims_scan": f"""
        select cif_number, full_name, phone_contact, address_notes, social_media from case_form f
        join pv_person p on p.id = f.main_pv_id join country_stations s on s.id = f.station_id""",
    "victim_ids": f"""
        select {cid('cif_number')} as case_id, full_name as name, phone_contact as phone, address_notes as address, social_media,
          case when cif_number like '%.1' then left(cif_number, length(cif_number) - 2) || '.V1'
            else left(cif_number, length(cif_number) - 1) || '.V' || (ascii(right(cif_number, 1)) - 64) end as victim_id,
          '' as narrative from victims_scan""",
    "victims_new": f"select * exclude (rn_) from ({first_rows('victim_ids', 'victim_id', 'name, phone, address, social_media')}) where name <> ''",
    "suspects_new": f"select {cid('cif_number')} as case_id, suspect_id, full_name as name, phone_contact as phone, address_notes as address, "
                    f"social_media as social_media_id, case_notes as narrative from ({first_rows('noted', 'suspect_id', 'interview_date desc, cif_number, person_id')})",
    "arrested_ids": "select distinct suspect_id from sus_forms where arrest = 1",
    **lifecycle_parts(),
    "willing": willing_sql(WILLING),
    "located": f"select case_id, count(*) as located_count, string_agg(name, ', ' order by name) as located from suspects_sheet where {STEP} group by case_id",
    "arrests_by_case": f"select {case_of('suspect_id')} as case_id, cast(sum(arrest) as bigint) as others_arrested from sus_forms group by 1",
    "police_by_case": f"select case_id, max(case when {STEP} then 1 else 0 end)::int as willing_to_arrest from police_sheet group by case_id",
    "forms_by_case": f"select {cid('cif_number')} as case_id, max(interview_date) as interview_date, max({BELIEF_WEIGHT}) as belief_score, "
                     f"max({EXPLOITATION}) as exploitation_score from sus_forms group by 1",
    "soc_by_suspect": first_rows("soc_scores", "suspect_id", "interview_date desc, cif_number, soc", "suspect_id, soc"),
    "components": f"""
        select s.*, {MULTIPLIER} as willing_score, {BIO} as bio_known, coalesce(a.others_arrested, 0) as others_arrested, p.willing_to_arrest,
          coalesce(case when 1 - 0.01::double * {AGE} > 0 then 1 - 0.01::double * {AGE} else 0::double end, 0::double) as recency_score,
          f.belief_score, f.exploitation_score, round(k.soc, 3) as strength_of_case
        from suspects_sheet s left join willing w using (case_id) left join arrests_by_case a using (case_id)
        left join police_by_case p using (case_id) left join forms_by_case f using (case_id) left join soc_by_suspect k using (suspect_id)""",
    "solved": f"select *, {solvability_sql(fv.SOLVABILITY_WEIGHTS)} as solvability from components",
    "scored": f"select *, {priority_sql(TYPED_EMINENCE)} as priority from solved",
    **graph_parts("g_", "links"),
    **incremental_parts(),
    "g_suspect_case": "select distinct s.suspect_id, c.case_number from g_case_suspects s join g_cases c on c.id = s.case_id",
    "g_edge_cases": "select distinct e.source_account_id, e.target_account_id, o.case_number from g_edges e "
                    "join g_suspect_case o on o.suspect_id = e.source_suspect_id",
    "d1": "select source_suspect_id as suspect_id, count(source_account_id) as first_degree_links from g_edges group by 1",
    "shared_targets": "select target_account_id from g_edges group by 1 having count(distinct source_account_id) >= 2",
    "d2": "select source_suspect_id as suspect_id, count(*) as second_degree_links from g_edges "
          "where target_account_id in (select target_account_id from shared_targets) group by 1",
    "d2_coded": "select source_suspect_id as suspect_id, count(distinct source_account_id) as second_degree_links from g_edges "
                "where source_account_id in (select target_account_id from g_edges) group by 1",
    "c1": case_links_sql("source_account_id", "first_degree_case_links"),
    "c2": case_links_sql("target_account_id", "second_degree_case_links"),
    "g_stats": "select s.id, s.name, coalesce(first_degree_links, 0) as first_degree_links, coalesce(second_degree_links, 0) as second_degree_links, "
               "coalesce(first_degree_case_links, 0) as first_degree_case_links, coalesce(second_degree_case_links, 0) as second_degree_case_links "
               "from g_suspects s left join d1 on d1.suspect_id = s.id left join d2 on d2.suspect_id = s.id "
               "left join c1 on c1.suspect_id = s.id left join c2 on c2.suspect_id = s.id",
    "with_links": "select g.*, k.suspect_case_id from g_stats g join g_case_suspects k on k.suspect_id = g.id",
    "net_weights": f"""
        select suspect_case_id, max(least(3::double, first_degree_case_links / {DAMPING} * 0.5::double
          + second_degree_case_links / {DAMPING} * 0.5::double * 0.5::double)) as network_weight
        from with_links group by suspect_case_id""",
    "lifted": f"select s.*, {LIFTED_EMINENCE} as lifted from solved s left join net_weights n on n.suspect_case_id = s.suspect_id",
    "account_members": "select distinct target as match, case_id as idx2 from links",
    "account_pairs": "select a.match, a.idx1, b.idx2 from (select distinct source as match, case_id as idx1 from links) a "
                     "join account_members b on a.match = b.match and a.idx1 <> b.idx2",
    "v2_components": f"""
        select s.suspect_id, case when willing_count >= 7 then 1::double else 1 - pow(0.5::double, coalesce(willing_count, 0)) end as willing_score,
          (case when bio_and_location = '' then 0 else 1 end)::int as bio_known, coalesce(a.n, 0) as others_arrested, p.willing_to_arrest,
          coalesce(case when {AGE} < 100 then 1 - {AGE} * 0.01::double else 0::double end, 0::double) as recency_score,
          round(k.soc, 3) as strength_of_case, {TYPED_EMINENCE} as em
        from suspects_sheet s
        left join (select case_id, count(*) as willing_count from victims_sheet where {STEP} group by 1) w using (case_id)
        left join (select case_id, count(*) as n from arrests group by 1) a using (case_id)
        left join police_by_case p using (case_id)
        left join (select {cid('cif_number')} as case_id, max(interview_date) as interview_date from case_form group by 1) f using (case_id)
        left join soc_by_suspect k using (suspect_id)""",
}


def run_parts() -> dict[str, str]:
    """The scoring parts over the lists of a run, after closing, instead of over the sheets; scores from a digest of the keys."""
    out = {
        "r_suspects": "select uid as suspect_id, a.case_id, a.name, a.case_status, a.date_closed, s.eminence "
                      "from suspects_active3 a left join suspects_sheet s on s.suspect_id = a.uid",
        "r_police": "select uid as suspect_id, case_id, name, case_status, date_closed from police_active3",
        "r_victims": "select uid as victim_id, case_id, name, case_status, date_closed from victims_active3",
        "r_soc": "select suspect_id, interview_date, cif_number, "
                 "cast('0x' || left(md5(suspect_id || ':' || cif_number), 7) as bigint) % 997 / 997::double as soc from sus_forms",
    }
    names = {"suspects_sheet": "r_suspects", "police_sheet": "r_police", "victims_sheet": "r_victims", "soc_scores": "r_soc"}
    taken = ("willing", "police_by_case", "soc_by_suspect", "components", "solved", "lifted")
    names |= {n: f"r_{n}" for n in taken if n != "lifted"}  # a column is called so too
    for name in taken:
        out[f"r_{name}"] = re.sub(r"'(?:[^']|'')*'|\b[a-z_]+\b", lambda m: names.get(m[0], m[0]), PARTS[name])
    out["r_scored"] = f"select *, {priority_sql('lifted')} as priority from r_lifted"
    return out


PARTS.update(run_parts())


_WORD = re.compile(r"\b[a-z][a-z0-9_]*\b")
_LITERAL = re.compile(r"'(?:[^']|'')*'")


def build(sql: str) -> str:
    """The query with every part it needs, directly or through other parts, in front."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for word in dict.fromkeys(_WORD.findall(_LITERAL.sub("", text))):
            if word in PARTS and word not in needed:
                needed[word] = ""
                visit(PARTS[word])
                needed[word] = PARTS[word]
                needed[word] = needed.pop(word)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} as ({text})" for name, text in needed.items())
    return f"with {parts}\n{sql}"


FEATURES_V3 = f"""
    select cif_number, interview_date, suspect_id, person_id, arrest,
      coalesce(number_of_victims, 1)::double as number_of_victims, number_of_traffickers::double as number_of_traffickers,
      {', '.join(f'coalesce({c}, false) as {c}' for c in fv.CASE_FORM_FLAGS if c != 'exploitation_organ_removal_occ')},
      {DIGITS} as expected_earning, total_blue_flags::double as total_blue_flags,
      {destination_sql([p for p in fv.PLACES_V3 if p != 'Kyegegwa'], False)}, {BELIEFS}
    from sus_forms"""

EDUCATION = ", ".join(f"coalesce(education = '{v}', false) as \"education_{v}\"" for v in
                      ("None/Illiterate", "Primary", "Secondary", "University"))
OCCUPATION = ", ".join(f"coalesce(pv_occupation = '{v}', false) as \"pv_occupation_{v}\"" for v in ("Farmer", "Trader"))
MISSING = "education is null as education_nan, pv_occupation is null as pv_occupation_nan"

FEATURES_V2 = f"""
    select cif_number, interview_date, suspect_id, coalesce(number_of_victims, 0)::double as number_of_victims,
      number_of_traffickers::double as number_of_traffickers, total_blue_flags::double as total_blue_flags,
      known_broker_years::double as known_broker_years, {destination_sql(fv.PLACES_V2, True)},
      {box_hit('recruited_broker_pb')}, {box_hit('how_recruited_broker_online_pb')}, {EDUCATION}, {OCCUPATION}, {MISSING},
      {', '.join(f"station_id = {i} as station_id_{i}" for i in range(25))},
      {', '.join(f'coalesce({c}, false) as {c}' for c in fv.CASE_FORM_FLAGS)}
    from (select * replace (coalesce(pb_number, 0) as pb_number), {sid('cif_number', 'pb_number')} as suspect_id from scan_all
      qualify row_number() over (partition by {sid('cif_number', 'pb_number')} order by interview_date desc, cif_id, person_id) = 1)"""


def _lifecycle_rows(suffix_parts: dict[str, str]) -> str:
    rows = []
    for g in ENTITIES:
        for part, suffix in suffix_parts.items():
            label = f", '{part}' as part" if len(suffix_parts) > 1 else ""
            rows.append(f"select '{g}' as entity, uid, case_id, name, case_status, date_closed{label} from {g}_{suffix}")
    return " union all ".join(rows)


def _g_stat(part: str, column: str) -> str:
    return (f"select s.name, coalesce(d.{column}, 0) as {column} from g_suspects s left join {part} d on d.suspect_id = s.id")


def _tabs(columns: str) -> str:
    """All bound tabs, stacked."""
    tabs = {"suspects": ("suspect_id", "suspects_sheet"), "closed_sus": ("suspect_id", "suspects_closed"),
            "police": ("suspect_id", "police_sheet"), "closed_pol": ("suspect_id", "police_closed"),
            "victims": ("victim_id", "victims_sheet"), "closed_vic": ("victim_id", "victims_closed")}
    return " union all ".join(
        f"select '{name}' as tab, case_id, {uid} as uid, {columns} from {table}" for name, (uid, table) in tabs.items())


PART = ("(case when spot < 200 then 'test' when spot < 300 then 'validation' else 'train' end)")
SPOT = "cast('0x' || left(md5(suspect_id || ':17'), 8) as bigint) % 1000 as spot"


def _scored_keys(parted: bool, decided: bool, condition: str = "true") -> str:
    part = f", {PART} as part" if parted else ""
    where = f"where {AGE} > 90 or arrest = 1" if decided else ""
    return (f"select suspect_id, cif_number{part}, true as in_range from (select *, {SPOT} from sus_forms {where}) "
            f"where {condition}")


TEXTS = {
    "s1_relational_query": "select cif_number, full_name, arrested from case_form f join person_box b on f.id = b.cif_id "
                           "join person p on p.id = b.person_id where arrested = 'Yes'",
    "s2_case_form_scan": f"select {FORM_COLUMNS}, cif_id, person_id, pb_number, arrested, pv_believes, role, station_name from scan",
    "s2b_case_form_scan_all": "select * from scan_all",
    "s3_suspect_scan": f"select cif_number, {CONTACTS}, arrested, person_id from scan",
    "s3b_suspect_scan_all": "select b.person_id, full_name, phone_contact, social_media, address1_id, address2_id from person_box b "
                            "join person p on p.id = b.person_id",
    "s4_victim_scan": "select * from victims_scan",
    "s4b_victim_scan_all": "select cif_number, full_name, phone_contact, social_media, address1_id, address2_id from case_form f "
                           "join pv_person p on p.id = f.main_pv_id",
    "s5_incident_notes": "select irf_number, case_notes from incident_notes",
    "s6_addresses": "select address1_id, address_1, address2_id, address_2 from addresses",
    "s7_sheet_reader": _tabs("case_status, date_closed") + " union all select 'cases', '', '', '', '' from cases_sheet "
                       "union all select 'arrests', '', '', '', '' from arrests_sheet",
    "s8_backup": f"select tab, case_id, uid, case_status, snapshot_date from ({_tabs('case_status, date_closed')}), "
                 f"(select cast({AS_OF} - n as date) as snapshot_date, n from (values (0), (1), (2)) as t(n)) "
                 "where n < 2 or length(date_closed) <= 1",
    "s9_csv_sink": _tabs("case_status"),
    "s10_publish": "select tab, case_id as \"Case_ID\", uid as \"Uid\", case_status as \"Case_Status\", date_closed as \"Date_Closed\" from ("
                   + _tabs("case_status, date_closed") + ")",
    "s11_training_columns": f"""
        select feature as "column", sum(v) as total from (
          unpivot (select columns(* exclude (cif_number, interview_date, suspect_id, person_id, arrest))::double,
                     coalesce({AGE} > 90 or arrest = 1, false) as decided from ({FEATURES_V3}))
          on columns(* exclude decided) into name feature value v)
        group by feature having max(case when decided and v <> 0 then 1 else 0 end) = 1""",
    "s12_graph_store": "select t.id::int as id, t.edge_type, t.edge_type_weight::int as edge_type_weight, n.links from (values "
                       + ", ".join(str(t) for t in fv.EDGE_TYPES) + ") t(id, edge_type, edge_type_weight) left join "
                       "(select relationship_type, count(*) as links from links group by 1) n on n.relationship_type = t.edge_type",
    "s13_graph_replace": "select name, first_degree_links, second_degree_links, first_degree_case_links, second_degree_case_links from g_stats",
    "s14_recent_links": f"""
        select sheet_id, row_no, suspect_case_id, source, target from links where suspect_case_id in (
          select suspect_id from suspects_sheet where try_strptime(date_relationships_updated, '%m/%d/%Y')::date >= {AS_OF} - 1)""",
    "p1_pick_addresses": "select address_1, address2_id, address_2 from addresses",
    "p2_drop_columns": f"select {', '.join(f'cast({c} as integer) as {c}' for c in fv.CASE_FORM_FLAGS)}, cif_number, interview_date, station_id, number_of_victims, number_of_traffickers, total_blue_flags, "
                       "planned_destination, education, pv_occupation, known_broker_years, recruited_broker_pb, "
                       "how_recruited_broker_online_pb, pb_number from scan_all",
    "p3_case_id": f"select cif_number, {cid('cif_number')} as case_id from case_form",
    "p4_suspect_id": f"select cif_number, person_id, {sid('cif_number', 'pb_number')} as suspect_id from scan_all",
    "p5_victim_rows": "select * from victims_new",
    "p6_suspect_rows": "select * from suspects_new",
    "p7_suspect_filter": "select cif_number, person_id, pb_number, role, suspect_id from sus_forms",
    "p8_narrative": f"select cif_number, person_id, {narrative_sql()} as narrative from sus_forms",
    "p9_notes": "select cif_number, person_id, case_notes from noted",
    "p10_destination_flags": f"select id, regexp_replace(planned_destination, '[^\\w\\s]+', '', 'g') as planned_destination, "
                             f"{destination_sql((*fv.PLACES_V3, *fv.PLACES_V2), True)} from case_form",
    "p11_box_flags": f"select cif_id, person_id, pb_number, {box_hit('recruited_broker_pb')}, {box_hit('how_recruited_broker_online_pb')} from scan_all",
    "p12_belief_flags": f"select id, pv_believes, {BELIEFS} from person",
    "p13_coerce": "select id, coalesce(number_of_victims, 0)::double as number_of_victims, "
                  "coalesce(try_cast(expected_earning as double), 0) as expected_earning, "
                  "coalesce(legal_action_taken <> '', false) as legal_action_taken, coalesce(recruited_agency, false) as recruited_agency, "
                  "interview_date from case_form",
    "p14_category_flags": f"select id, {EDUCATION}, {OCCUPATION}, {MISSING} from case_form",
    "p14b_category_vocabulary": VOCABULARY,
    "p14c_category_ids": f"select f.id, e.id as education_id, o.id as pv_occupation_id from case_form f "
                         f"left join ({VOCABULARY}) e on e.feature = 'education' and e.value is not distinct from cast(f.education as varchar) "
                         f"left join ({VOCABULARY}) o on o.feature = 'pv_occupation' and o.value is not distinct from cast(f.pv_occupation as varchar)",
    "p15_digits": f"select id, {DIGITS} as earning from case_form",
    "p16_defaults": f"select id, coalesce(number_of_victims, 1) as number_of_victims, {DIGITS} as expected_earning from case_form",
    "p17_drop_empty": "select id, known_broker_years, exploitation_organ_removal_exp from case_form",
    "p18_features": FEATURES_V3,
    "p18b_features_v2": FEATURES_V2,
    "p19_country": f"select suspect_id, case_id, name from suspects_sheet where left(suspect_id, 3) in "
                   f"(select station_code from station_key where country_name = {COUNTRY})",
    "p20_address_text": "select b.person_id, case when a.address2_id is null then '' else a.address_2 || ', ' || a.address_1 end as address "
                        "from person_box b join person p on p.id = b.person_id left join addresses a on a.address2_id = coalesce(p.address2_id, 0)",
    "p21_edge_direction": "select sheet_id, row_no, edge_direction from links",
    "p22_account_type": "select sheet_id, row_no, (case when contains(source, 'facebook') then 1 else 2 end)::int as source_type, "
                        "(case when contains(target, 'facebook') then 1 else 2 end)::int as target_type from links",
    "p23_combo_id": "select sheet_id, row_no, source || (case edge_direction when 1 then '<->' when 2 then '->' else '<-' end) || target as combo_id, "
                    "case edge_direction when 1 then least(source, target) || '<->' || greatest(source, target) "
                    "when 2 then source || '->' || target else source || '<-' || target end as canonical_id from links",
    "p24_link_fill": "select sheet_id, row_no, name, case_id, suspect_case_id, edge_direction from links",
    "p25_close_stamp": "select suspect_id, '08/01/2001' as date_closed from suspects_closed union all "
                       "select suspect_id, '08/01/2001' from police_closed",
    "p26_location_flag": "select id, coalesce(contains(address_notes, 'Kampala'), false)::int as located_in from person",
    "p27_arrest_label": "select id, (case when arrested = 'Yes' then 1 else 0 end)::int as arrest from person",
    "p28_case_name": "select s.suspect_id, s.case_id, coalesce(c.case_name, '') as case_name from suspects_sheet s left join "
                     "(select case_id, min(case_name) as case_name from cases_sheet group by 1) c using (case_id)",
    "j1_inner_chain": "select station_name, role, count(*) as rows from scan group by 1, 2",
    "j2_left": f"select s.suspect_id, s.case_id, a.total_arrests from suspects_sheet s left join (select {case_of(sid('cif_number', 'pb_number'))} as case_id, "
               "cast(sum(cif_id % 3) as bigint) as total_arrests from scan_all group by 1) a using (case_id)",
    "j3_full_outer": "select suspect_id, s.name as suspect_sheet_name, p.suspect_name as police_closed_name "
                     "from suspects_sheet s full join police_closed p using (suspect_id)",
    "j4_label_join": f"select x.suspect_id, cif_number, person_id, coalesce(a.arrest, 0)::int as arrest from (select cif_number, person_id, "
                     f"{sid('cif_number', 'pb_number')} as suspect_id from scan_all) x left join (select distinct suspect_id, arrest from arrests) a "
                     "on a.suspect_id = x.suspect_id",
    "j5_semi": "select suspect_id, name from suspects_sheet where suspect_id in (select suspect_id from police_closed)",
    "j6_anti": "select suspect_id, name from suspects_sheet where suspect_id not in (select suspect_id from police_sheet)",
    "j7_natural": "select case_id, suspect_id, p.suspect_name, s.eminence from police_sheet p join suspects_sheet s using (case_id, suspect_id)",
    "j8_right_wins": "select suspect_id, p.suspect_name, s.narrative, s.eminence from police_sheet p full join suspects_sheet s using (suspect_id)",
    "j9_other_index": "select match, count(distinct idx1) as source_cases, count(*) as case_pairs from account_pairs group by 1",
    "j10_lookup": f"select suspect_id, (case coalesce(n, 0) when 1 then 0.4 when 2 then 0.7 when 3 then 0.9 else 0 end)::double as willing_score "
                  f"from suspects_sheet left join (select case_id, count(*) as n from victims_sheet where {STEP} group by 1) using (case_id)",
    "a1_willing_victims": "select * from willing",
    "a1b_willing_victims_v2": willing_sql(STEP),
    "a2_located_suspects": "select * from located",
    "a3_total_arrests": "select case_id, others_arrested as total_arrests from arrests_by_case",
    "a4_arrest_rows": "select case_id, name, arrested, arrest_date, suspect_id, total_arrests, arrest from arrests",
    "a5_first_degree": _g_stat("d1", "first_degree_links"),
    "a6_second_degree": _g_stat("d2", "second_degree_links"),
    "a6b_second_degree_coded": _g_stat("d2_coded", "second_degree_links"),
    "a7_multi_match": "select match, idx1, count(*) as match_count from account_pairs group by 1, 2",
    "a7b_multi_match_members": "select match, idx2 from account_members where match in (select match from account_pairs)",
    "a8_case_links_first": _g_stat("c1", "first_degree_case_links"),
    "a8b_case_links_second": _g_stat("c2", "second_degree_case_links"),
    "w1_group_count": "select suspect_id, case_id, count(*) over (partition by case_id) as suspects_in_case from suspects_sheet",
    "w2_keep_first": "select cif_id, person_id, pb_number from person_box",
    "w3_first_row_fill": "select sheet_id, row_no, name from links",
    "t1_sort_by_priority": "select suspect_id, priority from scored order by priority desc, suspect_id",
    "t2_top_rows": "select suspect_id, case_id, priority from scored order by priority desc, suspect_id limit 200",
    "t3_link_work_list": "select suspect_id || '_relationships' as sheet_id, name, replace(regexp_replace(suspect_id, '\\.PB[0-9]+$', ''), '.', '') as case_id, "
                         "suspect_id as suspect_case_id, '' as source from (select * from scored order by priority desc, suspect_id limit 200) "
                         "where relationships = ''",
    "t4_first_by_name": first_rows("person", "phone_contact", "full_name, id", "full_name, phone_contact, id"),
    "t5_sorted_merge": "select suspect_id, s.eminence, p.case_status from suspects_sheet s full join police_sheet p using (suspect_id) order by 1",
    "u1_union_by_name": "select suspect_id, name, eminence, null as case_status from suspects_sheet union all "
                        "select suspect_id, null, null, case_status from police_sheet",
    "u2_union_by_position": "select case_id, suspect_id, name from suspects_closed union all select case_id, suspect_id, suspect_name from police_closed",
    "u3_first_table_wins": "select suspect_id, name from suspects_sheet union all select suspect_id, name from suspects_new "
                           "where suspect_id not in (select suspect_id from suspects_sheet)",
    "u4_insert_if_absent": "select suspect_id, case_id, name from suspects_new where suspect_id not in (select suspect_id from suspects_sheet)",
    "l1_combine": _lifecycle_rows({"active": "combined"}),
    "l2_close_finished": _lifecycle_rows({"active": "active2", "closed": "closed2"}),
    "l3_propagate_closing": "select * from (" + _lifecycle_rows({"active": "active3", "closed": "closed3"})
                            + ") where part = 'active' or coalesce(case_id, '') <> ''",
    "l3b_propagate_closing_v2": _lifecycle_rows({"active": "active3", "closed": "closed3"}),
    "l4_incident_notes": "select s.suspect_id, s.case_id, n.notes as irf_case_notes from suspects_sheet s left join "
                         "(select irf_number, min(case_notes) as notes from incident_notes group by 1) n on n.irf_number = s.case_id",
    "l5_willing_names": "select suspect_id, coalesce(willing_to_testify, '') as victims_willing_to_testify from police_sheet left join willing using (case_id)",
    "l6_located_names": "select victim_id, coalesce(located, '') as suspects_identified_and_located from victims_sheet left join located using (case_id)",
    "l7_copy_priority": f"select v.victim_id, coalesce(t.priority, 0) as priority, coalesce(t.narrative, '') as narrative from victims_sheet v left join "
                        f"({first_rows('scored', 'case_id', 'priority desc, suspect_id')}) t using (case_id)",
    "l7b_copy_priority_police": "select p.suspect_id, s.priority, p.narrative from police_sheet p join scored s using (suspect_id)",
    "l8_case_roll_up": f"""
        select t.case_id, t.case_name, t.priority, t.irf_case_notes, t.narrative,
          case when p.done then '{fv.CASE_STATUS_POLICE}' when s.done then '{fv.CASE_STATUS_LOCATED}'
            when w.willing_count >= 2 then '{fv.CASE_STATUS_TWO_WILLING}' when w.willing_count = 1 then '{fv.CASE_STATUS_ONE_WILLING}' else '' end as case_status,
          case when p.done then '{fv.NEXT_ACTION_ARREST}' when s.done then '{fv.NEXT_ACTION_POLICE}'
            when w.willing_count >= 1 then '{fv.NEXT_ACTION_LOCATE}' else '{fv.NEXT_ACTION_CONTACT}' end as next_action_priority
        from ({first_rows('scored', 'case_id', 'priority desc, suspect_id')}) t left join willing w using (case_id)
        left join (select distinct case_id, true as done from police_sheet where contains(case_status, 'Complete')) p using (case_id)
        left join (select distinct case_id, true as done from suspects_sheet where contains(case_status, 'Complete')) s using (case_id)""",
    "l9_entity_setup": "select 'suspects' as entity, suspect_id as uid, case_id, name from suspects_new union all "
                       "select 'police', suspect_id, case_id, name from suspects_new union all select 'victims', victim_id, case_id, name from victims_new",
    "c1_willing_score": "select suspect_id, willing_score from components",
    "c2_arrest_scores": "select suspect_id, bio_known, others_arrested, willing_to_arrest from components",
    "c3_recency": "select suspect_id, round(recency_score, 6) as recency_score from components",
    "c3b_recency_curve": f"select suspect_id, round(coalesce(case when 1 - 0.00001::double * pow({AGE}, 1.5) > 0 then 1 - 0.00001::double * pow({AGE}, 1.5) "
                         "else 0 end, 0::double), 6) as recency_score from suspects_sheet left join forms_by_case using (case_id)",
    "c3c_recency_v2": "select suspect_id, round(recency_score, 6) as recency_score from v2_components",
    "c4_belief": "select suspect_id, belief_score from components",
    "c5_exploitation": "select suspect_id, round(exploitation_score, 6) as exploitation_score from components",
    "c6_network_scores": f"select suspect_case_id, round(first_degree_case_links / {DAMPING}, 6) as first_score, "
                         f"round(second_degree_case_links / {DAMPING}, 6) as second_score from with_links",
    "c7_network_weight": "select suspect_id, round(network_weight, 6) as network_weight from suspects_sheet left join net_weights on suspect_case_id = suspect_id",
    "c8_eminence": f"select suspect_id, {TYPED_EMINENCE} as plain, round(lifted, 6) as lifted from lifted",
    "c9_strength": "select suspect_id, strength_of_case from components",
    "c10_weights": f"select suspect_id, round({solvability_sql({**fv.SOLVABILITY_WEIGHTS, 'PV_Believes': 0.0})}, 6) as solvability from components",
    "c11_solvability": "select suspect_id, round(solvability, 6) as solvability from solved",
    "c12_priority": "select suspect_id, priority from scored",
    "c13_all_scores": f"select suspect_id, {priority_sql('lifted')} as priority, strength_of_case, round(solvability, 6) as solvability, "
                      "round(lifted, 6) as eminence_score from lifted order by priority desc, suspect_id limit 200",
    "c13b_all_scores_v2": "select suspect_id, round(solvability, 6) as solvability, " + priority_sql("em") + " as priority from (select *, "
                          "(willing_score * 2 + bio_known * 2 + others_arrested + willing_to_arrest + recency_score * 4) / 14::double as solvability from v2_components)",
    "m3_split": f"select suspect_id, cif_number, arrest, {PART} as part from (select *, {SPOT} from sus_forms)",
    "m4_forest": _scored_keys(True, True),
    "m5_fit_predict": _scored_keys(True, True, "spot between 200 and 299"),
    "m6_grid_search": _scored_keys(True, True),
    "m7_train": _scored_keys(False, False),
    "m8_save_load": _scored_keys(False, False),
    "m9_score_new_rows": _scored_keys(False, False),
    "m2_training_rows": f"select suspect_id, cif_number, {AGE} as days, arrest from sus_forms where {AGE} > 90 or arrest = 1",
    "n1_suspects": "select id, name from g_suspects",
    "n2_accounts": "select * from g_accounts",
    "n3_edges": "select * from g_edges",
    "n4_cases": "select id, case_number, cast(null as date) as case_date from g_cases",
    "n5_case_suspects": "select * from g_case_suspects",
    "n6_bulk_import": "select e.id as edge_id, a.account_name as source, t.account_name as target, e.edge_type_id, e.edge_direction, c.case_number "
                      "from g_edges e join g_account_ids a on a.account_id = e.source_account_id join g_account_ids t on t.account_id = e.target_account_id "
                      "left join g_suspect_case c on c.suspect_id = e.source_suspect_id",
    "n7_new_suspects": "select 'suspects' as part, id, name as value from i_suspects union all select 'cases', id, case_number from i_cases "
                       "union all select 'case_suspects', id, suspect_case_id from i_case_suspects",
    "n8_new_accounts": "select id, account_name, account_label, account_type_id, suspect_id from i_accounts",
    "n9_new_edges": "select * from i_edges",
    "n10_add_sheets": f"""
        select distinct 'suspects' as part, name as value, '' as detail from links
        union all select distinct 'cases', case_id, '' from links
        union all select distinct 'accounts', account_name, cast(case when contains(lower(account_name), 'facebook') then 1 else 2 end as varchar)
          from (select source as account_name from links union all select target from links)
        union all select 'case_suspects', name, case_id || ' ' || suspect_case_id from ({first_rows('links', 'name', 'row_no, sheet_id')})
        union all select distinct 'edges', source, target || ' ' || edge_direction from i_first_links""",
    "e1_run_v3": f"""
        select 'suspects' as tab, suspect_id as uid, case_id, coalesce(name, '') as name, coalesce(case_status, '') as case_status,
          coalesce(date_closed, '') as date_closed, priority from r_scored
        union all select 'police', p.suspect_id, p.case_id, coalesce(p.name, ''), coalesce(p.case_status, ''), coalesce(p.date_closed, ''),
          coalesce(s.priority, 0) from r_police p left join r_scored s using (suspect_id)
        union all select 'victims', v.victim_id, v.case_id, coalesce(v.name, ''), coalesce(v.case_status, ''), coalesce(v.date_closed, ''),
          coalesce(t.priority, 0) from r_victims v left join ({first_rows('r_scored', 'case_id', 'priority desc, suspect_id')}) t using (case_id)
        union all select 'top_suspects', suspect_id, case_id, coalesce(name, ''), coalesce(case_status, ''), coalesce(date_closed, ''), priority
          from (select * from r_scored order by priority desc, suspect_id limit 200)
        {' '.join(f"union all select '{tab}', uid, case_id, coalesce(name, ''), coalesce(case_status, ''), coalesce(date_closed, ''), null "
                  f"from {g}_closed3 where coalesce(case_id, '') <> ''" for g, tab in (
                      ("suspects", "closed_sus"), ("police", "closed_pol"), ("victims", "closed_vic")))}
        union all select 'cases', t.case_id, t.case_id, '',
          case when p.done then '{fv.CASE_STATUS_POLICE}' when s.done then '{fv.CASE_STATUS_LOCATED}'
            when w.willing_count >= 2 then '{fv.CASE_STATUS_TWO_WILLING}' when w.willing_count = 1 then '{fv.CASE_STATUS_ONE_WILLING}' else '' end,
          case when p.done then '{fv.NEXT_ACTION_ARREST}' when s.done then '{fv.NEXT_ACTION_POLICE}'
            when w.willing_count >= 1 then '{fv.NEXT_ACTION_LOCATE}' else '{fv.NEXT_ACTION_CONTACT}' end, t.priority
        from ({first_rows('r_scored', 'case_id', 'priority desc, suspect_id')}) t left join r_willing w using (case_id)
        left join (select distinct case_id, true as done from r_police where contains(case_status, 'Complete')) p using (case_id)
        left join (select distinct case_id, true as done from r_suspects where contains(case_status, 'Complete')) s using (case_id)""",
    "n11_link_stats": "select * from g_stats",
}


M1_NUMBERS = ("number_of_victims", "number_of_traffickers", "expected_earning", "total_blue_flags")
# Two flags are never set in the bound tables, and not in the SQL: organ removal, and the destination Kyegegwa.
M1_FLAGS = sorted([c for c in fv.CASE_FORM_FLAGS if c != "exploitation_organ_removal_occ"] + [c for c, _ in fv.BELIEF_WORDS] + [
    "destination_gulf", *(f"destination_{p}" for p in fv.PLACES_V3 if p != "Kyegegwa")])
TEXTS["m1_feature_vector"] = (
    f"select suspect_id, cif_number, cast({len(M1_FLAGS) + 2 + len(M1_NUMBERS)} as bigint) as places, array_to_string(list_filter(["
    + ", ".join(f"case when {c} then '{c}' end" for c in M1_FLAGS) + "], lambda x: x is not null), ',') as set_flags, "
    + ", ".join(f"coalesce(round(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), 6), 0) + 0.0::double as scaled_{c}" for c in M1_NUMBERS)
    + f" from ({FEATURES_V3})")


def oracle_sql() -> dict[str, str]:
    return {name: build(sql) for name, sql in TEXTS.items()}
