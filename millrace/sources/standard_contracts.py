"""The sixteen delivery-support files. Names, types, bounds and value lists below are fixed values."""

from __future__ import annotations

from millrace.contract import ColumnRule, ContractBook, FileContract, ForeignKey


def _key(name: str, type: str = "integer") -> ColumnRule:
    return ColumnRule(name, type, pk=True, nullable=False)


def _ref(name: str, table: str, nullable: bool = True, type: str = "integer") -> ColumnRule:
    return ColumnRule(name, type, nullable=nullable, fk=ForeignKey(name, name, table))


def _stamps() -> tuple[ColumnRule, ColumnRule]:
    return ColumnRule("created_at", "timestamp"), ColumnRule("updated_at", "timestamp")


TICKET_STATUSES = ("Open", "InProgress", "Resolved", "Closed", "Reopened")
ORDER_STATUSES = ("Delivered", "Cancelled", "In Transit", "Pending", "Refunded")

LOOKUPS = [
    FileContract("cities.json", (
        _key("city_id"),
        ColumnRule("city_name", nullable=False),
        ColumnRule("country"),
        ColumnRule("timezone"),
    )),
    FileContract("regions.csv", (
        _key("region_id"),
        ColumnRule("region_name", nullable=False),
        _ref("city_id", "cities.json", nullable=False),
        ColumnRule("delivery_base_fee", "float"),
    )),
    FileContract("categories.csv", (
        _key("category_id"),
        ColumnRule("category_name", nullable=False),
    )),
    FileContract("segments.csv", (
        _key("segment_id"),
        ColumnRule("segment_name", nullable=False),
        ColumnRule("discount_pct", "float"),
        ColumnRule("priority_support", "boolean"),
    )),
    FileContract("teams.csv", (
        _key("team_id"),
        ColumnRule("team_name", nullable=False),
    )),
    FileContract("reason_categories.csv", (
        _key("reason_category_id"),
        ColumnRule("category_name", nullable=False),
    )),
]

ENTITIES = [
    FileContract("customers.csv", (
        _key("customer_id"),
        ColumnRule("full_name", pii=True),
        ColumnRule("email", format="email", pii=True),
        ColumnRule("phone", format="phone", pii=True),
        _ref("region_id", "regions.csv"),
        _ref("segment_id", "segments.csv"),
        ColumnRule("signup_date", "timestamp"),
        ColumnRule("gender", expected_values=("male", "female")),
        *_stamps(),
    ), target_dimension="DIM_CUSTOMER"),
    FileContract("drivers.csv", (
        _key("driver_id"),
        ColumnRule("driver_name", pii=True),
        ColumnRule("driver_phone", format="phone", pii=True),
        ColumnRule("national_id", pii=True),
        _ref("region_id", "regions.csv"),
        ColumnRule("shift", expected_values=("morning", "evening", "night")),
        ColumnRule("vehicle_type", expected_values=("car", "bike", "motorbike")),
        ColumnRule("hire_date", "timestamp"),
        ColumnRule("rating_avg", "float", minimum=1, maximum=5),
        ColumnRule("on_time_rate", "float", minimum=0, maximum=1),
        ColumnRule("cancel_rate", "float", minimum=0, maximum=1),
        ColumnRule("completed_deliveries", "integer"),
        ColumnRule("is_active", "boolean"),
        *_stamps(),
    ), target_dimension="DIM_DRIVER"),
    FileContract("restaurants.json", (
        _key("restaurant_id"),
        ColumnRule("restaurant_name"),
        _ref("region_id", "regions.csv"),
        _ref("category_id", "categories.csv"),
        ColumnRule("price_tier", expected_values=("Low", "Mid", "High")),
        ColumnRule("rating_avg", "float", minimum=1, maximum=5),
        ColumnRule("prep_time_avg_min", "integer"),
        ColumnRule("is_active", "boolean"),
        *_stamps(),
    ), target_dimension="DIM_RESTAURANT"),
    FileContract("agents.csv", (
        _key("agent_id"),
        ColumnRule("agent_name", pii=True),
        ColumnRule("agent_email", format="email", pii=True),
        ColumnRule("agent_phone", format="phone", pii=True),
        _ref("team_id", "teams.csv"),
        ColumnRule("skill_level", expected_values=("Junior", "Mid", "Senior", "Lead")),
        ColumnRule("hire_date", "timestamp"),
        ColumnRule("avg_handle_time_min", "integer"),
        ColumnRule("resolution_rate", "float", minimum=0, maximum=1),
        ColumnRule("csat_score", "float", minimum=0, maximum=5),
        ColumnRule("is_active", "boolean"),
        *_stamps(),
    ), target_dimension="DIM_AGENT"),
    FileContract("channels.csv", (
        _key("channel_id"),
        ColumnRule("channel_name", nullable=False),
    ), target_dimension="DIM_CHANNEL"),
    FileContract("priorities.csv", (
        _key("priority_id"),
        ColumnRule("priority_code", nullable=False),
        ColumnRule("priority_name", nullable=False),
        ColumnRule("sla_first_response_min", "integer", nullable=False),
        ColumnRule("sla_resolution_min", "integer", nullable=False),
    ), target_dimension="DIM_PRIORITY"),
    FileContract("reasons.csv", (
        _key("reason_id"),
        ColumnRule("reason_name", nullable=False),
        _ref("reason_category_id", "reason_categories.csv", nullable=False),
        ColumnRule("severity_level", "integer", nullable=False, minimum=1, maximum=5),
        ColumnRule("typical_refund_pct", "float", minimum=0, maximum=1),
    ), target_dimension="DIM_REASON"),
]

TRANSACTIONS = [
    FileContract("orders.json", (
        _key("order_id", "varchar"),
        _ref("customer_id", "DIM_CUSTOMER"),
        _ref("restaurant_id", "DIM_RESTAURANT"),
        _ref("driver_id", "DIM_DRIVER"),
        ColumnRule("region_id", "integer"),
        ColumnRule("order_amount", "float", nullable=False, minimum=0),
        ColumnRule("delivery_fee", "float", minimum=0),
        ColumnRule("discount_amount", "float", minimum=0),
        ColumnRule("total_amount", "float", nullable=False, minimum=0),
        ColumnRule("payment_method"),
        ColumnRule("order_status", nullable=False, expected_values=ORDER_STATUSES),
        ColumnRule("order_created_at", "timestamp"),
        ColumnRule("delivered_at", "timestamp"),
    ), "stream", target_fact="FACT_TICKET_LIFECYCLE", write_priority=1),
    FileContract("tickets.csv", (
        _key("ticket_id", "varchar"),
        _ref("order_id", "FACT_TICKET_LIFECYCLE", nullable=False, type="varchar"),
        _ref("reason_id", "DIM_REASON"),
        ColumnRule("refund_amount", "float", minimum=0),
        ColumnRule("status", nullable=False, expected_values=TICKET_STATUSES),
        ColumnRule("created_at", "timestamp", nullable=False),
    ), "stream", target_fact="FACT_TICKET_LIFECYCLE", write_priority=2),
    FileContract("ticket_events.json", (
        _key("event_id", "varchar"),
        ColumnRule("ticket_id", nullable=False),
        ColumnRule("agent_id", "integer"),
        ColumnRule("old_status", expected_values=TICKET_STATUSES),
        ColumnRule("new_status", nullable=False, expected_values=TICKET_STATUSES),
        ColumnRule("event_ts", "timestamp", nullable=False),
        ColumnRule("notes", pii=True),
    ), "stream", target_fact="FACT_TICKET_LIFECYCLE", write_priority=3),
]

# Columns the ticket files carry beyond their contract; the fact needs them.
TICKET_EXTRAS = {
    "customer_id": "integer",
    "driver_id": "integer",
    "restaurant_id": "integer",
    "agent_id": "integer",
    "priority_id": "integer",
    "channel_id": "integer",
    "first_response_at": "timestamp",
    "resolved_at": "timestamp",
    "sla_first_due_at": "timestamp",
    "sla_resolve_due_at": "timestamp",
}

STANDARD = ContractBook([*LOOKUPS, *ENTITIES, *TRANSACTIONS])
