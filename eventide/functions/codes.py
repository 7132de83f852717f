"""Fixed values that must equal the reference for identical results.

Every list below is stated once, in the reference's natural order.
"""

# --- fixed values: terminal order statuses -------------------------------
ORDER_TERMINAL = [
    "COMPLETED", "CANCELLED", "FAILED", "REJECTED",
    "PAYMENT_FAILED", "INVENTORY_FAILED", "SHIPPING_FAILED",
]
# --- fixed values: statuses from which payment may start -----------------
ORDER_CAN_PAY = ["NEW", "APPROVED"]
# --- fixed values: status-update names kept as is; anything else -> FAILED
STATUS_UPDATE_KNOWN = [
    "COMPLETED", "CANCELLED", "PAYMENT_FAILED", "INVENTORY_FAILED", "SHIPPING_FAILED",
]

# --- fixed values: saga states (declaration order) and their phase -------
SAGA_STATE_PHASE = [
    ("STARTED", "INITIAL"),
    ("PAYMENT_PENDING", "PAYMENT"),
    ("PAYMENT_COMPLETED", "PAYMENT"),
    ("PAYMENT_FAILED", "PAYMENT"),
    ("INVENTORY_PENDING", "INVENTORY"),
    ("INVENTORY_RESERVED", "INVENTORY"),
    ("INVENTORY_FAILED", "INVENTORY"),
    ("SHIPPING_PENDING", "SHIPPING"),
    ("SHIPPING_FAILED", "SHIPPING"),
    ("COMPLETED", "TERMINAL"),
    ("COMPENSATING", "COMPENSATING"),
    ("COMPENSATED", "TERMINAL"),
]
SAGA_FAILURE_STATES = ["PAYMENT_FAILED", "INVENTORY_FAILED", "SHIPPING_FAILED"]
# --- fixed values: compensation strategy per failed state ----------------
SAGA_STRATEGY = [
    ("PAYMENT_FAILED", "CANCEL_ORDER_ONLY"),
    ("INVENTORY_FAILED", "REFUND_AND_CANCEL"),
    ("SHIPPING_FAILED", "FULL_COMPENSATION"),
]
SAGA_PENDING_STATES = ["PAYMENT_PENDING", "INVENTORY_PENDING", "SHIPPING_PENDING"]

# --- fixed values: saga event types of the batch event log ---------------
# event type -> (state after the event, failed state it records or None)
SAGA_EVENTS = [
    ("OrderCreated", "PAYMENT_PENDING", None),
    ("PaymentCompleted", "PAYMENT_COMPLETED", None),
    ("PaymentFailed", "COMPENSATING", "PAYMENT_FAILED"),
    ("InventoryRequested", "INVENTORY_PENDING", None),
    ("InventoryReserved", "INVENTORY_RESERVED", None),
    ("InventoryFailed", "COMPENSATING", "INVENTORY_FAILED"),
    ("ShippingRequested", "SHIPPING_PENDING", None),
    ("ShippingCompleted", "COMPLETED", None),
    ("ShippingFailed", "COMPENSATING", "SHIPPING_FAILED"),
    ("CompensationCompleted", "COMPENSATED", None),
]
SAGA_START_EVENT = "OrderCreated"

# --- fixed values: compensation topics and types --------------------------
TOPIC_PAYMENT_REFUND = "payment.refund"
TOPIC_INVENTORY_RELEASE = "inventory.release"
TOPIC_ORDER_CANCEL = "order.cancel"
TOPIC_PAYMENT_RESULT = "payment.result"
COMPENSATION_REFUND = "REFUND"
COMPENSATION_RELEASE = "RELEASE"
COMPENSATION_CANCEL = "CANCEL"
ENVELOPE_REFUND = "PaymentRefundRequested"
ENVELOPE_RELEASE = "InventoryReleaseRequested"
ENVELOPE_CANCEL = "OrderCancellationRequested"

# --- fixed values: payment statuses and burn-rate inputs -------------------
PAYMENT_OK = "CHARGED"
PAYMENT_BAD = "CHARGE_FAILED"
PAYMENT_UNKNOWN = "UNKNOWN"
PAYMENT_REFUNDED = "REFUNDED"

# --- fixed values: fraud rules ---------------------------------------------
FRAUD_HIGH_VALUE = "1000.00"
FRAUD_REVIEW_SCORE = 70
FRAUD_REJECT_SCORE = 90
FRAUD_VALUE_TIERS = [("5000", 50), ("2000", 35)]
FRAUD_VALUE_BASE = 20
FRAUD_VELOCITY_HIGH = 40
FRAUD_VELOCITY_LOW = 20
FRAUD_ROUND_SCORE = 15
FRAUD_OFF_HOURS_SCORE = 10
FRAUD_OFF_HOURS = (1, 5)
FRAUD_SCORE_CAP = 100
FRAUD_VELOCITY_WINDOW_MINUTES = 60
FRAUD_VELOCITY_MAX_ORDERS = 5

# --- fixed values: text formats --------------------------------------------
REASON_HIGH_VALUE = "High value order: $%.2f (score +%.1f)"
REASON_VELOCITY = "Velocity anomaly detected (score +%.1f)"
REASON_ROUND = "Suspiciously round amount (score +15)"
REASON_OFF_HOURS = "Off-hours order (score +10)"
REASON_TIMEOUT = "Timeout waiting for %s response"
REASON_RETRY = "Retry compensation attempt #%d"
REASON_COMPENSATED = "Order cancelled after compensation"
REASON_CANCEL_PREFIX = "Cancelled: "
REASON_PAYMENT_DECLINED = "Payment declined"
REASON_SHIPPING_FAILED = "Shipping failed"
REASON_UNKNOWN_INVENTORY = "Unknown inventory status: "
DEFAULT_ADDRESS = "Default Address - Please Update"
DEFAULT_REJECT_REASON = "Rejected during manual review"
ERROR_ORDER_NOT_FOUND = "Order not found: "
ERROR_CANNOT_APPROVE = "Cannot approve order in status: "

# --- fixed values: dead-letter topic suffixes (case-exact) ----------------
DLT_SUFFIX_REGEX = r"(-dlt|-DLT|\.DLT|\.dlt)$"

# --- fixed values: further texts and defaults -------------------------------
REASON_OUT_OF_STOCK = "Inventory out of stock"
REASON_UNKNOWN_SHIPPING = "Unknown shipping status: "
CURRENCY_DEFAULT = "USD"
CUSTOMER_DEFAULT = "N/A"

# dead-letter record header that holds the cause (fixed value)
EXCEPTION_HEADER = "x-exception-message"
