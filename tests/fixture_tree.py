"""A small delivery-support day on disk: master, batch and stream files with known defects."""

import csv
import json
import os


def write_csv(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, list(rows[0]))
        out.writeheader()
        out.writerows(rows)


def write_json(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f)


T0 = "2024-01-01 00:00:00"


def master(folder):
    write_csv(f"{folder}/cities.csv", [
        dict(city_id=1, city_name="Cairo", country="Egypt", timezone="Africa/Cairo"),
        dict(city_id=2, city_name="Giza", country="Egypt", timezone="Africa/Cairo")])
    write_csv(f"{folder}/regions.csv", [
        dict(region_id=1, region_name="Maadi", city_id=1, delivery_base_fee="10.5"),
        dict(region_id=2, region_name="Dokki", city_id=2, delivery_base_fee="12"),
        dict(region_id=3, region_name="Nowhere", city_id=9, delivery_base_fee="1")])  # no such city
    write_csv(f"{folder}/categories.csv", [dict(category_id=1, category_name="Grill")])
    write_csv(f"{folder}/segments.csv", [
        dict(segment_id=1, segment_name="Gold", discount_pct="5", priority_support="True")])
    write_csv(f"{folder}/teams.csv", [dict(team_id=1, team_name="North")])
    write_csv(f"{folder}/reason_categories.csv", [dict(reason_category_id=1, category_name="Food")])


def customer(i, region=1, **over):
    row = dict(customer_id=i, full_name=f"Person {i}", email=f"p{i}@mail.org", phone=f"0101234567{i}",
               region_id=region, segment_id=1, signup_date=T0, gender="female", created_at=T0, updated_at=T0)
    row.update(over)
    return row


def batch(folder, people=(1, 2)):
    write_csv(f"{folder}/customers.csv", [
        *[customer(i) for i in people],
        customer(7, phone="abc12345"), customer(8, region=77),  # bad phone, unknown region
        customer(1, updated_at="2023-01-01 00:00:00", full_name="Old name")])  # earlier copy
    write_csv(f"{folder}/drivers.csv", [dict(
        driver_id=1, driver_name="D", driver_phone="01112345678", national_id="29", region_id=2, shift="night",
        vehicle_type="bike", hire_date=T0, rating_avg="4.5", on_time_rate="0.9", cancel_rate="0.1",
        completed_deliveries=10, is_active="True", created_at=T0, updated_at=T0)])
    write_json(f"{folder}/restaurants.json", [dict(
        restaurant_id=1, restaurant_name="Koshary", region_id=1, category_id=1, price_tier="Mid", rating_avg=4.2,
        prep_time_avg_min=15.0, is_active=True, created_at=T0, updated_at=T0)])
    write_csv(f"{folder}/agents.csv", [dict(
        agent_id=1, agent_name="A", agent_email="a@b.org", agent_phone="01212345678", team_id=1,
        skill_level="Senior", hire_date=T0, avg_handle_time_min=5, resolution_rate="0.5", csat_score="4.5",
        is_active="true", created_at=T0, updated_at=T0)])
    write_csv(f"{folder}/channels.csv", [dict(channel_id=1, channel_name="Chat")])
    write_csv(f"{folder}/priorities.csv", [dict(
        priority_id=1, priority_code="P1", priority_name="High", sla_first_response_min=1, sla_resolution_min=15)])
    write_csv(f"{folder}/reasons.csv", [dict(
        reason_id=1, reason_name="Late", reason_category_id=1, severity_level=3, typical_refund_pct="0.5")])


def order(i, customer_id=1, **over):
    row = dict(order_id=f"o{i}", customer_id=customer_id, restaurant_id=1, driver_id=1, region_id=1,
               order_amount=100.0, delivery_fee=10.0, discount_amount=5.0, total_amount=105.0,
               payment_method="cash", order_status="Delivered", order_created_at="2024-01-05 08:00:00",
               delivered_at="2024-01-05 08:40:00")
    row.update(over)
    return row


def ticket(i, **over):
    row = dict(ticket_id=f"t{i}", order_id=f"o{i}", reason_id=1, refund_amount="21", status="Closed",
               created_at="2024-01-05 09:00:30", customer_id=1, driver_id=1, restaurant_id=1, agent_id=1,
               priority_id=1, channel_id=1, first_response_at="", resolved_at="", sla_first_due_at="",
               sla_resolve_due_at="")
    row.update(over)
    return row


def event(i, ticket_id, new, ts, old="Open", notes=None):
    return dict(event_id=f"e{i}", ticket_id=ticket_id, agent_id=1, old_status=old, new_status=new,
                event_ts=ts, notes=notes)


def stream(root, date="2024-01-05"):
    """Two hours. t1 is answered on the minute boundary, resolved, reopened and resolved again; t2
    goes straight to closed; t3 has no events; o4 belongs to an unknown customer."""
    h8, h9 = f"{root}/{date}/08", f"{root}/{date}/09"
    write_json(f"{h8}/orders.json", [order(1), order(2), order(3, total_amount=0.5, order_amount=0.5),
                                     order(4, customer_id=99.0), order(5, order_amount=-1.0)])
    write_csv(f"{h8}/tickets.csv", [ticket(1), ticket(2)])
    write_json(f"{h8}/ticket_events.json", [
        event(1, "t1", "InProgress", "2024-01-05 09:01:00", notes="Agent responded"),
        event(2, "t1", "Resolved", "2024-01-05 09:20:00", "InProgress"),
        event(3, "t2", "InProgress", "2024-01-05 09:10:00"),
        event(4, "t2", "Closed", "2024-01-05 09:30:00", "InProgress")])
    write_json(f"{h9}/orders.json", [order(2), order(6)])
    write_csv(f"{h9}/tickets.csv", [ticket(3), ticket(2), ticket(9)])  # t9: no such order
    write_json(f"{h9}/ticket_events.json", [
        event(5, "t1", "Reopened", "2024-01-05 10:00:00", "Resolved"),
        event(6, "t1", "Resolved", "2024-01-05 10:05:00", "Reopened")])
