"""DuckDB twins of the Spark operators, as named CTEs.

Each oracle query of the registry is ``with_ctes(body, *names)``: the named
CTEs (and, recursively, what they read, down to the fixtures of
``tidewater.sources.fixtures``) are prefixed to ``body``.  Rounding rules shared
with the Spark side: money to 2 places, rates and averages to 6.
"""

from __future__ import annotations

from tidewater.schemas import INVENTORY, ORDERS, PAYMENTS, SHIPPING, columns_for
from tidewater.sources.fixtures import AS_OF, FX_SQL, SERVICE_FIXTURE, _DEPS, _duck_text

SHORT = {ORDERS: "orders", PAYMENTS: "payments", INVENTORY: "inventory", SHIPPING: "shipping"}
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def _q(c: str) -> str:
    return f'"{c}"'


def rules_sql(service: str) -> list[tuple[str, str]]:
    rules = [
        ("not_null_event_id", "event_id IS NOT NULL"),
        ("not_null_timestamp", '"timestamp" IS NOT NULL'),
        ("valid_timestamp", f'"timestamp" <= {AS_OF_SQL}'),
        ("not_empty_event_type", "(event_type IS NOT NULL AND event_type <> '')"),
    ]
    if service == PAYMENTS:
        rules += [("positive_amount", "amount > 0"),
                  ("valid_currency", "currency IN ('BRL', 'USD', 'EUR', 'GBP')")]
    elif service == ORDERS:
        rules += [("positive_amount", "total_amount >= 0")]
    return rules


def valid_expr(service: str) -> str:
    return "coalesce(" + " AND ".join(r for _, r in rules_sql(service)) + ", false)"


def _dedup_sql(service: str) -> str:
    fx = SERVICE_FIXTURE[service]
    cols = columns_for(service)
    order = ["timestamp"] + [c for c in cols if c not in ("event_id", "timestamp")]
    ob = ", ".join(f"{_q(c)} ASC NULLS FIRST" for c in order)
    sel = ", ".join(_q(c) for c in cols)
    return (f"SELECT {sel} FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {ob}) AS _rn "
            f"FROM {fx} WHERE event_id IS NOT NULL) WHERE _rn = 1 "
            f"UNION ALL SELECT {sel} FROM {fx} WHERE event_id IS NULL")


CTES: dict[str, tuple[tuple[str, ...], str]] = {}
for _svc, _s in SHORT.items():
    CTES[f"dd_{_s}"] = ((SERVICE_FIXTURE[_svc],), _dedup_sql(_svc))
    CTES[f"flag_{_s}"] = ((f"dd_{_s}",), f"SELECT *, {valid_expr(_svc)} AS _is_valid FROM dd_{_s}")
    CTES[f"valid_{_s}"] = ((f"flag_{_s}",), f"SELECT * EXCLUDE (_is_valid) FROM flag_{_s} WHERE _is_valid")
    CTES[f"invalid_{_s}"] = ((f"flag_{_s}",), f"SELECT * EXCLUDE (_is_valid) FROM flag_{_s} WHERE NOT _is_valid")

CTES["latest_orders"] = (("valid_orders",), """
SELECT order_id, customer_id, status AS order_status, total_amount, currency, items_count,
       "timestamp" AS order_updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC, event_id DESC) AS _rn
      FROM valid_orders WHERE event_type IN ('ORDER_CREATED', 'ORDER_UPDATED', 'ORDER_COMPLETED'))
WHERE _rn = 1""")
CTES["latest_payments"] = (("valid_payments",), """
SELECT order_id, payment_id, status AS payment_status, method AS payment_method, gateway AS payment_gateway,
       amount AS payment_amount, "timestamp" AS payment_updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC, event_id DESC) AS _rn
      FROM valid_payments)
WHERE _rn = 1""")
CTES["latest_shipping"] = (("valid_shipping",), """
SELECT order_id, shipment_id, status AS shipping_status, carrier, tracking_code,
       "timestamp" AS shipping_updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC, event_id DESC) AS _rn
      FROM valid_shipping)
WHERE _rn = 1""")
CTES["timeline"] = (("latest_orders", "latest_payments", "latest_shipping"), """
SELECT o.*, p.payment_id, p.payment_status, p.payment_method, p.payment_gateway, p.payment_amount,
       p.payment_updated_at, s.shipment_id, s.shipping_status, s.carrier, s.tracking_code, s.shipping_updated_at,
       CASE WHEN p.payment_amount IS NOT NULL THEN abs(o.total_amount - p.payment_amount) < 0.01 END AS payment_match,
       CASE WHEN s.shipping_updated_at IS NOT NULL THEN
            date_diff('second', date_trunc('second', o.order_updated_at), date_trunc('second', s.shipping_updated_at)) / 3600.0
       END AS order_lifecycle_hours
FROM latest_orders o LEFT JOIN latest_payments p USING (order_id) LEFT JOIN latest_shipping s USING (order_id)""")
CTES["unified"] = (("valid_orders", "valid_payments", "valid_inventory", "valid_shipping"), " UNION ALL ".join(
    f"SELECT event_id, event_type, \"timestamp\", '{svc}' AS _service FROM valid_{s}" for svc, s in SHORT.items()))


def add_cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        deps = CTES[n][0] if n in CTES else _DEPS.get(n, ())
        for d in deps:
            if d in CTES or d in FX_SQL:
                visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        text = CTES[n][1] if n in CTES else _duck_text(n)
        # read by several parts of a query: computed once
        how = "MATERIALIZED " if n.startswith(("fx_", "dd_")) else ""
        parts.append(f"{n} AS {how}({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
