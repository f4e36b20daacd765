"""The ten order states and the groups of them the reports ask for."""

# Status id, name, position in the order flow.
ORDER_STATUS = [
    (1, "Awaiting Payment", 1),
    (2, "Payment Confirmed", 2),
    (3, "Picking", 3),
    (4, "Shipped", 4),
    (5, "In Transit", 5),
    (6, "Out for Delivery", 6),
    (7, "Delivered", 7),
    (8, "Cancelled", 8),
    (9, "Returned", 9),
    (10, "Refunded", 10),
]

AWAITING = "Awaiting Payment"
CONFIRMED = "Payment Confirmed"
DELIVERED = "Delivered"
CANCELLED = "Cancelled"
VOID = ("Cancelled", "Refunded")
MOVING = ("Shipped", "In Transit")

# Status ids that stamp a time on the order, and the flow position from which
# an order may be closed whatever its present state.
STAMP_PAYMENT = 2
STAMP_SHIPPING = 4
STAMP_DELIVERY = 7
CLOSING_FLOW = 8
