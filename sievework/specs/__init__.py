"""Ready-made table specifications."""

from sievework.specs.booking import BOOKING, booking_spec
from sievework.specs.warehouse import CUSTOMER, LINEITEM, ORDERS

__all__ = ["BOOKING", "CUSTOMER", "LINEITEM", "ORDERS", "booking_spec"]
