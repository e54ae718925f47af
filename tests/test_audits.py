"""Audits count exactly the injected violations (and NULL passes a CHECK)."""

import datetime as dt
from decimal import Decimal as Dec

from adlens.operators import audits
from adlens.plans.catalog import catalog
from tests.conftest import SF_SMALL, make_model

T = dt.datetime.fromisoformat
D = dt.date.fromisoformat


def test_injected_violations_are_counted(spark):
    m = make_model(spark, {
        "campaigns": [(1, "A", "S", None), (1, "A2", "S", None)],                       # duplicate PK
        "users": [(1, D("2024-03-05"), D("2024-03-01"), None, None),                    # registration < first seen
                  (2, D("2024-03-05"), None, None, None)],                              # NULL passes
        "clicks": [(10, 1, T("2024-03-01T00:00:00"), None), (11, 9, T("2024-03-01T00:00:00"), None)],  # FK
        "sessions": [(100, 1, 1, 10, "Mobile", None, T("2024-03-01T00:01:00")),
                     (101, 3, 1, 10, "Mobile", None, T("2024-03-01T00:02:00")),          # user 3 missing; click reused
                     (102, 2, 1, None, None, None, T("2024-03-01T00:03:00"))],           # NULL device
        "conversions": [(1000, 100, T("2024-03-01T00:05:00"), "Refund", Dec("1.00")),    # bad type
                        (1001, 555, T("2024-03-01T00:05:00"), "Lead", Dec("-1.00"))],    # FK + negative
        "costs_daily": [(D("2024-03-01"), 1, Dec("1.00")), (D("2024-03-01"), 1, Dec("2.00"))],  # duplicate PK
    })
    t = {n: m.table(n) for n in ("campaigns", "users", "clicks", "sessions", "conversions", "costs_daily")}

    def counts(df):
        return {(r.table_name, r.constraint_name): r.violations for r in df.collect()}

    pk = counts(audits.audit_pk(t))
    assert pk[("campaigns", "pk_campaign_id")] == 1 and pk[("costs_daily", "pk_cost_date_campaign_id")] == 1
    assert pk[("sessions", "uq_click_id")] == 1 and pk[("users", "pk_user_id")] == 0
    fk = counts(audits.audit_fk(t))
    assert fk[("sessions", "fk_user_id_users")] == 1
    assert fk[("clicks", "fk_campaign_id_campaigns")] == 1
    assert fk[("conversions", "fk_session_id_sessions")] == 1
    assert fk[("sessions", "fk_click_id_clicks")] == 0          # NULL click ids are not checked
    ck = counts(audits.audit_check(t))
    assert ck == {("users", "ck_registration_after_first_seen"): 1, ("conversions", "ck_conversion_type"): 1,
                  ("conversions", "ck_revenue_nonneg"): 1, ("costs_daily", "ck_cost_nonneg"): 0}
    nn = counts(audits.audit_not_null(t))
    assert nn[("sessions", "nn_device")] == 1 and sum(nn.values()) == 1
    bad = audits.fk_violations(t["conversions"], "session_id", t["sessions"], "session_id").collect()
    assert [r.conversion_id for r in bad] == [1001]


def test_dirty_tables_violate_every_constraint(spark):
    rows = [r for name in ("pk", "fk", "check", "not_null")
            for r in catalog()[f"audit_{name}_dirty"](spark, SF_SMALL).collect()]
    assert len(rows) == 38 and [r for r in rows if r.violations == 0] == []
