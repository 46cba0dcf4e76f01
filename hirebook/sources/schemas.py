"""Typed schemas of the business tables (DDL strings Spark accepts as is).

Loaders read with these schemas, never with inference: a column's type then
does not depend on which cells of a sheet happen to be blank. Movement, invoice and entry dates
are timestamps: a time of day counts against the bounds of a period and in
machine days. Sheets with plain dates load as midnight.
"""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    "equip_type": "equip_type_name string, equip_type_id int",
    "relocation": "q_id bigint, qt_id bigint, site_name string, equip_type_id int, equip_type_name string, "
                  "date timestamp, quantity bigint, direction int",
    "vq": "q_id bigint, qt_id bigint, ep_id bigint, ep_name string, quotation_type bigint, equip_type_id bigint, "
          "equip_quantity int, rent_daily double",
    "vq_equip": "qt_id bigint, quantity int",
    "vq_wholesale": "qt_id bigint, entry_date date, exit_date date",
    "equip_dailycost": "equip_type_name string, cost_day_std double",
    "invoice": "q_id bigint, client_id bigint, date timestamp, price double, vat double, price_vat_total double",
    "external_parties": "ep_id bigint, ep_name string, ep_type string",
    "ep_bf": "ep_id bigint, ma_account_id string, amount double",
    "chart_of_accounts": "ma_account_id string, ma_account_name string, ap_ar int",
    "account_bf": "ma_account_id string, bf_amount double",
    "bankstatement": "date timestamp, ma_account_id string, ma_account_name string, ep_id bigint, ep_name string, "
                     "amount double, vat double, is_cancelling int, suggested_cf bigint, cf_account_id bigint",
    "aje": "date timestamp, ma_account_id string, ma_account_name string, ep_id bigint, debit double, credit double, "
           "amount double",
    "payroll": "worker_id bigint, year int, month int, total_salary double, individual_income_tax double, "
               "social_security_employee double, house_tax double, social_security_employer double, "
               "social_security_recoverable int",
    "worker_info": "worker_id bigint, department string",
    "ppe_list": "company string, ppe_user string, starting string, historical_cost double, residual_value double, "
                "life int",
    "depr_alloc": "ppe_user string, ma_account_id string",
    "report_mapping": "ma_account_id string, ma_account_name string, fp string, pl string",
    "report_template": "fr string, line_no int, line_name string, source_code string, direction double, "
                       "add0i string, add1i string, add2i string, add3i string, "
                       "add0o string, add1o string, add2o string, add3o string",
    "cf_mapping": "cf_account_id bigint, cf string",
}
