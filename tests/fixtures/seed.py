"""The warehouse's Stage-1 seed rows, as a small typed model (no clicks).

Fixed values: these rows must equal the warehouse seed so the golden numbers
in the tests can be checked. Session and conversion ids are the load
positions (1-based), as IDENTITY assigns them on a fresh load.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

D = dt.date.fromisoformat
TS = dt.datetime.fromisoformat

# Fixed values (seed): campaign_name, channel, start_date
CAMPAIGNS = [
    ("Google Search – Brand", "Paid Search", "2024-02-01"),
    ("Facebook Leads", "Paid Social", "2024-02-05"),
    ("Organic Search", "Organic", None),
]

# Fixed values (seed): first_seen_date, registration_date, country, gender
USERS = [
    ("2024-02-10", None, "Israel", "Female"),
    ("2024-02-11", "2024-02-11", "Israel", "Male"),
    ("2024-02-12", "2024-02-13", "Israel", "Female"),
    ("2024-02-13", None, "USA", "Female"),
    ("2024-02-14", None, "UK", "Male"),
    ("2024-02-15", "2024-02-16", "Germany", "Female"),
    ("2024-02-16", None, "France", "Female"),
    ("2024-02-17", None, "Israel", "Other"),
    ("2024-02-18", "2024-02-20", "Canada", "Male"),
    ("2024-02-19", None, "Israel", "Female"),
    ("2024-02-20", "2024-02-20", "USA", "Male"),
    ("2024-02-21", None, "Israel", "Female"),
]

# Fixed values (seed): user_id, campaign_id, device, landing_page, session_datetime
SESSIONS = [
    (1, 1, "Mobile", "/home", "2024-02-10T10:15:00"),
    (1, 3, "Desktop", "/blog", "2024-02-10T18:40:00"),
    (2, 2, "Mobile", "/contact", "2024-02-10T20:45:00"),
    (2, 2, "Mobile", "/contact", "2024-02-11T09:05:00"),
    (3, 1, "Desktop", "/services", "2024-02-11T13:10:00"),
    (4, 1, "Mobile", "/landing", "2024-02-11T21:25:00"),
    (3, 1, "Desktop", "/pricing", "2024-02-12T08:20:00"),
    (5, 3, "Desktop", "/blog", "2024-02-12T11:30:00"),
    (1, 1, "Mobile", "/home", "2024-02-12T14:10:00"),
    (6, 2, "Mobile", "/landing", "2024-02-13T10:00:00"),
    (7, 3, "Desktop", "/about", "2024-02-13T12:40:00"),
    (4, 1, "Desktop", "/services", "2024-02-13T19:15:00"),
    (1, 1, "Mobile", "/contact", "2024-02-14T09:10:00"),
    (8, 2, "Mobile", "/home", "2024-02-14T11:55:00"),
    (9, 3, "Desktop", "/blog", "2024-02-14T21:20:00"),
    (10, 1, "Desktop", "/landing", "2024-02-15T08:40:00"),
    (2, 2, "Mobile", "/contact", "2024-02-15T12:10:00"),
    (6, 2, "Mobile", "/pricing", "2024-02-15T18:30:00"),
    (3, 3, "Desktop", "/blog", "2024-02-16T09:25:00"),
    (7, 1, "Mobile", "/services", "2024-02-16T13:05:00"),
    (11, 2, "Mobile", "/home", "2024-02-16T20:50:00"),
    (12, 1, "Desktop", "/services", "2024-02-17T10:10:00"),
    (1, 1, "Mobile", "/home", "2024-02-17T14:45:00"),
    (9, 3, "Desktop", "/about", "2024-02-17T22:05:00"),
    (2, 2, "Mobile", "/contact", "2024-02-18T09:15:00"),
    (6, 2, "Desktop", "/landing", "2024-02-18T12:00:00"),
    (10, 3, "Desktop", "/blog", "2024-02-18T19:40:00"),
    (3, 1, "Mobile", "/pricing", "2024-02-19T08:05:00"),
    (8, 2, "Mobile", "/home", "2024-02-19T11:30:00"),
    (11, 1, "Desktop", "/services", "2024-02-19T21:10:00"),
    (1, 1, "Mobile", "/home", "2024-02-20T09:00:00"),
    (5, 3, "Desktop", "/blog", "2024-02-20T12:45:00"),
    (9, 2, "Mobile", "/contact", "2024-02-20T20:15:00"),
    (6, 2, "Mobile", "/landing", "2024-02-21T10:05:00"),
    (12, 1, "Desktop", "/services", "2024-02-21T16:30:00"),
    (7, 3, "Desktop", "/about", "2024-02-21T21:55:00"),
    (2, 2, "Mobile", "/contact", "2024-02-22T09:45:00"),
    (3, 1, "Desktop", "/pricing", "2024-02-22T13:20:00"),
    (10, 3, "Desktop", "/blog", "2024-02-22T18:10:00"),
]

# Fixed values (seed): session_id, conversion_datetime, conversion_type, revenue
CONVERSIONS = [
    (1, "2024-02-10T10:18:00", "Lead", "0.00"),
    (3, "2024-02-10T20:47:00", "Registration", "0.00"),
    (5, "2024-02-11T13:25:00", "Purchase", "150.00"),
    (7, "2024-02-12T08:35:00", "Lead", "0.00"),
    (9, "2024-02-12T14:25:00", "Purchase", "250.00"),
    (10, "2024-02-13T10:12:00", "Registration", "0.00"),
    (12, "2024-02-13T19:28:00", "Lead", "0.00"),
    (13, "2024-02-14T09:18:00", "Purchase", "300.00"),
    (16, "2024-02-15T08:55:00", "Lead", "0.00"),
    (17, "2024-02-15T12:20:00", "Registration", "0.00"),
    (20, "2024-02-16T13:15:00", "Purchase", "200.00"),
    (23, "2024-02-17T14:52:00", "Lead", "0.00"),
    (28, "2024-02-18T12:10:00", "Purchase", "120.00"),
    (33, "2024-02-20T20:22:00", "Registration", "0.00"),
]

# Fixed values (seed): cost_date, campaign_id, cost
COSTS_DAILY = [
    ("2024-02-10", 1, "120.00"), ("2024-02-10", 2, "90.00"),
    ("2024-02-11", 1, "130.00"), ("2024-02-11", 2, "80.00"),
    ("2024-02-12", 1, "150.00"), ("2024-02-12", 2, "95.00"),
    ("2024-02-13", 1, "110.00"), ("2024-02-13", 2, "70.00"),
    ("2024-02-14", 1, "200.00"), ("2024-02-14", 2, "100.00"),
    ("2024-02-15", 1, "100.00"), ("2024-02-15", 2, "120.00"),
    ("2024-02-16", 1, "140.00"), ("2024-02-16", 2, "60.00"),
    ("2024-02-17", 1, "150.00"), ("2024-02-17", 2, "110.00"),
    ("2024-02-18", 1, "175.00"), ("2024-02-18", 2, "100.00"),
    ("2024-02-19", 1, "125.00"), ("2024-02-19", 2, "85.00"),
    ("2024-02-20", 1, "100.00"), ("2024-02-20", 2, "90.00"),
    ("2024-02-21", 1, "95.00"), ("2024-02-21", 2, "75.00"),
    ("2024-02-22", 1, "105.00"),
]


def rows():
    """Typed rows per model table (ids assigned by load position)."""
    return {
        "campaigns": [(i, n, c, D(s) if s else None) for i, (n, c, s) in enumerate(CAMPAIGNS, 1)],
        "users": [(i, D(f), D(r) if r else None, co, g) for i, (f, r, co, g) in enumerate(USERS, 1)],
        "clicks": [],
        "sessions": [(i, u, c, None, d, lp, TS(t)) for i, (u, c, d, lp, t) in enumerate(SESSIONS, 1)],
        "conversions": [(i, s, TS(t), ty, Decimal(r)) for i, (s, t, ty, r) in enumerate(CONVERSIONS, 1)],
        "costs_daily": [(D(d), c, Decimal(v)) for d, c, v in COSTS_DAILY],
    }
