"""Input tables as declared: all text on arrival, typed by the cleaners."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _text(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


FLIGHTS = _text("flight_id", "airline", "source", "destination", "departure_time", "arrival_time")
BOOKINGS = _text(
    "booking_id", "passenger_id", "flight_id", "booking_date", "status", "passport_number",
    "seat_number", "emergency_contact_name", "emergency_contact_phone",
)
PASSENGERS = _text(
    "passenger_id", "first_name", "last_name", "age", "gender", "email", "phone", "aadhaar_id", "date_of_birth",
)
PAYMENTS = _text("payment_id", "booking_id", "amount", "payment_method")

INPUTS = {"flights": FLIGHTS, "bookings": BOOKINGS, "passengers": PASSENGERS, "payments": PAYMENTS}
