"""Table schemas and other values that are fixed by the input data."""

from __future__ import annotations

from pyspark.sql.types import StructType

# The column names, order and types of the raw shop exports.
# NOT NULL states the intent; the CSV reader does not enforce it, so
# sources.readers.missing_keys checks it.
_SHOP_DDL = {
    "users": (
        "id BIGINT NOT NULL, first_name STRING, last_name STRING, email STRING, age INT, "
        "gender STRING, state STRING, street_address STRING, postal_code STRING, city STRING, "
        "country STRING, latitude DOUBLE, longitude DOUBLE, traffic_source STRING, "
        "created_at TIMESTAMP"
    ),
    "orders": (
        "order_id BIGINT NOT NULL, user_id BIGINT, status STRING, gender STRING, "
        "created_at TIMESTAMP, returned_at TIMESTAMP, shipped_at TIMESTAMP, "
        "delivered_at TIMESTAMP, num_of_item INT"
    ),
    "order_items": (
        "id BIGINT NOT NULL, order_id BIGINT, user_id BIGINT, product_id BIGINT, "
        "inventory_item_id BIGINT, status STRING, created_at TIMESTAMP, shipped_at TIMESTAMP, "
        "delivered_at TIMESTAMP, returned_at TIMESTAMP, sale_price DOUBLE"
    ),
    "products": (
        "id BIGINT NOT NULL, cost DOUBLE, category STRING, name STRING, brand STRING, "
        "retail_price DOUBLE, department STRING, sku STRING, distribution_center_id BIGINT"
    ),
    # user_id is written as decimal text ("15495.0"); it becomes a long on load.
    "events": (
        "id BIGINT NOT NULL, user_id DOUBLE, sequence_number INT, session_id STRING, "
        "created_at TIMESTAMP, ip_address STRING, city STRING, state STRING, "
        "postal_code STRING, browser STRING, traffic_source STRING, uri STRING, "
        "event_type STRING"
    ),
    "distribution_centers": (
        "id BIGINT NOT NULL, name STRING, latitude DOUBLE, longitude DOUBLE"
    ),
    "inventory_items": (
        "id BIGINT NOT NULL, product_id BIGINT, created_at TIMESTAMP, sold_at TIMESTAMP, "
        "cost DOUBLE, product_category STRING, product_name STRING, product_brand STRING, "
        "product_retail_price DOUBLE, product_department STRING, product_sku STRING, "
        "product_distribution_center_id BIGINT"
    ),
}

# Header of the complaints export and our name for each column.
COMPLAINT_COLUMNS = {
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "narrative",
    "Company public response": "company_public_response",
    "Company": "company",
    "State": "state",
    "ZIP code": "zip_code",
    "Tags": "tags",
    "Submitted via": "submitted_via",
    "Date sent to company": "date_sent_to_company",
    "Company response to consumer": "company_response",
    "Timely response?": "timely_response",
    "Complaint ID": "complaint_id",
}

# Order statuses that count as a purchase, and the one that
# removes an order item.
ACTIVE_STATUSES = ("Complete", "Shipped", "Processing", "Returned")
CANCELLED = "Cancelled"
RETURNED = "Returned"

HOME_COUNTRY = "United States"

# Postal code and name of the 50 states and DC.
US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin",
    "WY": "Wyoming", "DC": "District of Columbia",
}

# Product names that were changed over the years, old to new.
PRODUCT_RENAMES = {
    "Credit reporting, credit repair services, or other personal consumer reports":
        "Credit reporting or other personal consumer reports",
    "Payday loan, title loan, or personal loan":
        "Payday loan, title loan, personal loan, or advance loan",
    "Money transfer, virtual currency, or money service":
        "Money transfers",
}

# Columns of the churn dataset, in order.
DATASET_COLUMNS = (
    "user_id", "churned", "age", "gender", "state", "traffic_source",
    "order_count", "recency_days", "tenure_days", "orders_last_365d", "avg_items_per_order",
    "total_spent", "avg_item_price", "items_bought", "distinct_categories", "return_rate",
    "session_count", "avg_events_per_session", "days_since_last_visit", "cart_events",
)
CATEGORICAL_COLUMNS = ("gender", "state", "traffic_source")


def shop_schema(name: str) -> StructType:
    return StructType.fromDDL(_SHOP_DDL[name])


def shop_tables() -> tuple[str, ...]:
    return tuple(_SHOP_DDL)


def complaint_schema() -> StructType:
    """All text but the id; dates are parsed after the read."""
    schema = StructType()
    for header in COMPLAINT_COLUMNS:
        schema.add(header, "long" if header == "Complaint ID" else "string")
    return schema
