"""What the tables promise: keys, references, value rules, required columns."""

from tillspan.functions.text import EMAIL_SHAPE

# Columns no two rows may share; rows with a NULL among them do not take part.
UNIQUE: dict[str, list[tuple[str, ...]]] = {
    "categories": [("category_id",), ("name",)],
    "states": [("state_id",), ("code",)],
    "cities": [("city_id",), ("name", "state_id")],
    "payment_methods": [("method_id",), ("name",)],
    "order_status": [("status_id",), ("name",)],
    "customers": [("customer_id",), ("email",), ("tax_id",)],
    "products": [("product_id",), ("sku",)],
    "addresses": [("address_id",)],
    "orders": [("order_id",), ("order_no",)],
    "order_items": [("item_id",), ("order_id", "product_id")],
    "reviews": [("review_id",), ("product_id", "customer_id")],
    "carts": [("cart_id",)],
    "status_history": [("history_id",)],
    "coupons": [("coupon_id",), ("code",)],
    "audit_log": [("log_id",)],
}

# (child table, column, parent table, column). The last one is not declared anywhere but implied by the data.
REFERENCES: list[tuple[str, str, str, str]] = [
    ("categories", "parent_id", "categories", "category_id"),
    ("cities", "state_id", "states", "state_id"),
    ("products", "category_id", "categories", "category_id"),
    ("addresses", "customer_id", "customers", "customer_id"),
    ("addresses", "city_id", "cities", "city_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "address_id", "addresses", "address_id"),
    ("orders", "status_id", "order_status", "status_id"),
    ("orders", "method_id", "payment_methods", "method_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("reviews", "product_id", "products", "product_id"),
    ("reviews", "customer_id", "customers", "customer_id"),
    ("carts", "customer_id", "customers", "customer_id"),
    ("carts", "product_id", "products", "product_id"),
    ("status_history", "order_id", "orders", "order_id"),
    ("status_history", "old_status_id", "order_status", "status_id"),
    ("status_history", "new_status_id", "order_status", "status_id"),
    ("coupons", "category_id", "categories", "category_id"),
    ("orders", "coupon_code", "coupons", "code"),
]

# Rules as SQL conditions; a NULL result passes.
RULES: dict[str, dict[str, str]] = {
    "customers": {
        "gender": "gender IN ('M', 'F', 'O')",
        "level": "level BETWEEN 1 AND 10",
        "email": f"email RLIKE r'{EMAIL_SHAPE}'",
    },
    "products": {
        "price": "price >= 0",
        "promo_price": "promo_price >= 0",
        "cost": "cost >= 0",
        "stock": "stock >= 0",
        "promo_below_price": "promo_price IS NULL OR promo_price < price",
    },
    "addresses": {"kind": "kind IN ('DELIVERY', 'BILLING', 'BOTH')"},
    "orders": {
        "subtotal": "subtotal >= 0",
        "discount": "discount >= 0",
        "freight": "freight >= 0",
        "total": "total >= 0",
    },
    "order_items": {"qty": "qty > 0", "unit_price": "unit_price >= 0", "subtotal": "subtotal >= 0"},
    "reviews": {"rating": "rating BETWEEN 1 AND 5"},
    "carts": {"qty": "qty > 0", "owner": "customer_id IS NOT NULL OR session_id IS NOT NULL"},
    "coupons": {"kind": "kind IN ('PERCENT', 'FIXED')", "dates": "ends >= starts"},
    "audit_log": {"op": "op IN ('INSERT', 'UPDATE', 'DELETE')"},
}

REQUIRED: dict[str, list[str]] = {
    "categories": ["category_id", "name"],
    "states": ["state_id", "name", "code", "region"],
    "cities": ["city_id", "name", "state_id"],
    "payment_methods": ["method_id", "name"],
    "order_status": ["status_id", "name", "flow"],
    "customers": ["customer_id", "name", "email"],
    "products": ["product_id", "sku", "name", "category_id", "price"],
    "addresses": ["address_id", "customer_id", "postcode", "street", "number", "district", "city_id"],
    "orders": ["order_id", "order_no", "customer_id", "address_id", "status_id", "method_id", "subtotal", "total"],
    "order_items": ["item_id", "order_id", "product_id", "qty", "unit_price", "subtotal"],
    "reviews": ["review_id", "product_id", "customer_id", "rating"],
    "carts": ["cart_id", "product_id", "qty"],
    "status_history": ["history_id", "order_id", "new_status_id"],
    "coupons": ["coupon_id", "code", "kind", "value", "starts", "ends"],
    "audit_log": ["log_id", "table_name", "op"],
}
