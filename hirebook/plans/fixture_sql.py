"""The business-table derivations of FIXTURES.md part B in DuckDB SQL.

``with_fixtures(sql)`` prefixes a query with the CTEs it needs (found by
name), so each oracle text runs on DuckDB's pre-registered driver tables.
"""

from __future__ import annotations

import re

# Ordered: later derivations read earlier ones.
FIXTURE_SQL: dict[str, str] = {
    "equip_type": """select distinct p_type as equip_type_name, case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 when 'PROMO' then 4 when 'SMALL' then 5 else 6 end as equip_type_id from part""",
    "relocation": """select l_orderkey as q_id, l_orderkey*10+(equip_type_id-1)%3 as qt_id, concat('S',cast(l_suppkey%5 as varchar(20))) as site_name, equip_type_id, equip_type_name,
cast(l_shipdate as date) as date, cast(l_quantity as bigint) as quantity, case when l_returnflag='R' then -1 else 1 end as direction
from lineitem join part on l_partkey=p_partkey join equip_type on p_type=equip_type_name""",
    "vq": """select o_orderkey as q_id, o_orderkey*10+j as qt_id, o_custkey as ep_id, c_name as ep_name, o_orderkey%3 as quotation_type, 1+j+3*((o_orderkey // 3)%2) as equip_type_id,
case o_orderkey%4 when 0 then 1 when 1 then 3 when 2 then 7 else 9 end as equip_quantity, cast(cast(round(o_totalprice) as bigint) as double)/100 as rent_daily
from orders join customer on o_custkey=c_custkey cross join (select r_regionkey as j from region where r_regionkey<3) jj where j<=o_orderkey%3""",
    "vq_equip": """select qt_id, 1 as quantity from vq where quotation_type=2 union all select qt_id, equip_quantity-1 from vq where quotation_type=2 and equip_quantity>1""",
    "vq_wholesale": """select o_orderkey*10 as qt_id, cast(o_orderdate as date) as entry_date, cast(o_orderdate as date)+cast(case (o_orderkey // 3)%4 when 0 then 21 when 1 then 33 when 2 then 63 else 77 end as int) as exit_date from orders where o_orderkey%3=0""",
    "equip_dailycost": """select equip_type_name, 10+1.25E0*equip_type_id as cost_day_std from equip_type""",
    "invoice": """select l_orderkey as q_id, o_custkey as client_id, cast(l_shipdate as date) as date, cents/100E0 as price, (cents*6 // 100)/100E0 as vat, (cents+(cents*6 // 100))/100E0 as price_vat_total
from (select l_orderkey, l_shipdate, cast(round(l_extendedprice*100) as bigint) as cents from lineitem) l join orders on l_orderkey=o_orderkey""",
    "external_parties": """select c_custkey as ep_id, c_name as ep_name, 'client' as ep_type from customer union all select 1000000+s_suppkey, s_name, 'supplier' from supplier""",
    "ep_bf": """select c_custkey as ep_id, 'MA1122' as ma_account_id, c_acctbal as amount from customer union all select 1000000+s_suppkey, 'MA2202', -s_acctbal from supplier""",
    "chart_of_accounts": """select concat('MA',cast(1002+20*n_nationkey as varchar(20))) as ma_account_id, n_name as ma_account_name, case when n_nationkey%5=1 then 1 else 0 end as ap_ar from nation
union all select case r_regionkey when 0 then 'MA22210101' when 1 then 'MA22210102' else 'MA2202' end, r_name, case when r_regionkey=2 then 1 else 0 end from region where r_regionkey<3""",
    "account_bf": """select concat('MA',cast(1002+20*n_nationkey as varchar(20))) as ma_account_id, n_nationkey*1000E0 as bf_amount from nation where n_nationkey%7<>3""",
    "bankstatement": """select date, concat('MA',cast(1002+20*(1+k%24) as varchar(20))) as ma_account_id, concat('acct-',cast(1+k%24 as varchar(20))) as ma_account_name,
case when k%7=0 then null else o_custkey end as ep_id, case when k%7=0 then null else c_name end as ep_name, sgn*cents/100E0 as amount, case when k%53=0 then null else sgn*(cents*6 // 100)/100E0 end as vat,
case when o_orderstatus='P' then 1 end as is_cancelling, k%8 as suggested_cf, k%8 as cf_account_id
from (select o_orderkey as k, o_custkey, o_orderstatus, cast(o_orderdate as date) as date, cast(round(o_totalprice*100) as bigint) as cents, case when (o_orderkey // 24)%3=0 then -1 else 1 end as sgn from orders) o join customer on o_custkey=c_custkey""",
    "aje": """select date, concat('MA',cast(1002+20*a as varchar(20))) as ma_account_id, concat('acct-',cast(a as varchar(20))) as ma_account_name, case when l_suppkey%4=0 then null else 1000000+l_suppkey end as ep_id,
case when l_linestatus='F' then cents/100E0 end as debit, case when l_linestatus='F' then null else cents/100E0 end as credit, case when l_linestatus='F' then cents/100E0 else -cents/100E0 end as amount
from (select cast(l_shipdate as date) as date, l_partkey%25 as a, l_suppkey, l_linestatus, cast(round(l_extendedprice*100) as bigint) as cents from lineitem where l_returnflag='R') l""",
    "payroll": """select c_custkey as worker_id, 2021 as year, m as month, cents/100E0 as total_salary, (cents*3 // 100)/100E0 as individual_income_tax, (cents*10 // 100)/100E0 as social_security_employee, (cents*5 // 100)/100E0 as house_tax, (cents*20 // 100)/100E0 as social_security_employer,
case c_custkey%5 when 0 then 1 when 1 then 0 end as social_security_recoverable from (select c_custkey, 1000000+cast(round(c_acctbal*100) as bigint) as cents from customer) c cross join (select r_regionkey+1 as m from region where r_regionkey<3) r""",
    "worker_info": """select c_custkey as worker_id, case when c_custkey%89=0 then null else c_mktsegment end as department from customer where c_custkey%97<>5""",
    "ppe_list": """select concat('C',cast(p_size%3 as varchar(20))) as company, p_brand as ppe_user, concat(cast(1994+p_partkey%6 as varchar(20)),'-',lpad(cast(1+p_partkey%12 as varchar(20)),2,'0'),'-01') as starting,
cents/100E0 as historical_cost, (cents*5 // 100)/100E0 as residual_value, case p_partkey%5 when 0 then 7 when 1 then 9 when 2 then 21 when 3 then 33 else 63 end as life
from (select *, cast(round(p_retailprice*100) as bigint) as cents from part) p""",
    "depr_alloc": """select distinct p_brand as ppe_user, case when p_brand<'Brand#3' then 'MA560210' else 'MA540110' end as ma_account_id from part where p_brand<>'Brand#11'""",
    "report_mapping": """select ma_account_id, ma_account_name, case when ma_account_id<'MA11' then 'F1' when ma_account_id<'MA13' then 'F2' when ma_account_id like 'MA222%' then 'F3' when ma_account_id='MA1462' then null else 'F4' end as fp,
case when ma_account_id>='MA12' and ma_account_id<'MA14' then 'P1' when ma_account_id>='MA14' and ma_account_id<'MA15' then 'P2' end as pl from chart_of_accounts""",
    "report_template": """select * from (values ('FP',1,'Cash','F1',1,'T1',null,null,null,null,null,null,null),('FP',2,'Receivables','F2',1,'T1','U1',null,null,null,null,null,null),('FP',3,'Total assets',null,1,null,null,null,null,'T1',null,null,null),
('FP',4,'VAT','F3',-1,null,'U1',null,null,null,null,null,null),('FP',5,'Net',null,1,null,null,null,null,null,'U1',null,null),('FP',6,'Other','F4',-1,null,null,null,null,null,null,null,null),
('CF',1,'Operating','C1',-1,'T3',null,null,null,null,null,null,null),('CF',2,'Investing','C2',-1,'T3',null,null,null,null,null,null,null),('CF',3,'Financing','C3',-1,'T3',null,null,null,null,null,null,null),('CF',4,'Net change',null,-1,null,null,null,null,'T3',null,null,null),
('PL',1,'Sales','P1',-1,'T2',null,null,null,null,null,null,null),('PL',2,'Costs','P2',-1,'T2',null,null,null,null,null,null,null),('PL',3,'Profit',null,-1,null,null,null,null,'T2',null,null,null))
t(fr,line_no,line_name,source_code,direction,add0i,add1i,add2i,add3i,add0o,add1o,add2o,add3o)""",
    "cf_mapping": """select distinct cf_account_id, case when cf_account_id<3 then 'C1' when cf_account_id<6 then 'C2' when cf_account_id=6 then 'C3' end as cf from bankstatement""",
}


def _needed(sql: str, defined: dict[str, str]) -> list[str]:
    want: set[str] = set()
    stack = [sql]
    while stack:
        text = stack.pop()
        for name, body in defined.items():
            if name not in want and re.search(rf"\b{name}\b", text):
                want.add(name)
                stack.append(body)
    return [n for n in defined if n in want]


def with_fixtures(sql: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the fixture CTEs and ``ctes`` it references.

    ``ctes`` are operator-level CTEs (ordered); they may use fixtures and
    each other. Only referenced ones are emitted.
    """
    defined = dict(FIXTURE_SQL)
    defined.update(ctes or {})
    names = _needed(sql, defined)
    if not names:
        return sql
    parts = ",\n".join(f"{n} AS (\n{defined[n]}\n)" for n in names)
    return f"WITH {parts}\n{sql}"
