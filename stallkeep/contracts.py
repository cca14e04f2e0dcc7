"""Table contracts: column names, types, keys and references."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)

#: Column of a raw table that holds the whole line where it has too few or too many values.
MALFORMED = "malformed_line"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "money": MONEY,
}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    references: str


@dataclass(frozen=True)
class Contract:
    """One table: its columns in order, its declared key and references.

    `added` columns are computed after loading, so a load never supplies them.
    `partition` is a column the stored files are divided by, and how it follows from
    the others; inside a part, rows are in the order of `cluster`.
    """

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    comment: str = ""
    foreign_keys: tuple[ForeignKey, ...] = ()
    added: dict[str, str] = field(default_factory=dict)
    multiline_text: bool = False
    partition: tuple[str, str] | None = None
    cluster: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _TYPES[t]) for c, t in self.columns.items()])

    @property
    def full_schema(self) -> T.StructType:
        both = {**self.columns, **self.added}
        return T.StructType([T.StructField(c, _TYPES[t]) for c, t in both.items()])

    @property
    def raw_schema(self) -> T.StructType:
        """Landing files arrive as text; the contract types them later."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def landed_schema(self) -> T.StructType:
        """A raw table: the text columns, and the line of a row that doesn't fit them."""
        return T.StructType([*self.raw_schema, T.StructField(MALFORMED, T.StringType())])


def _by_name(*contracts: Contract) -> dict[str, Contract]:
    return {c.name: c for c in contracts}


# Table and column names and types of the sales data set. The
# spelling "lenght" is the data set's own.
CLEAN = _by_name(
    Contract(
        "customers",
        {
            "customer_id": "string",
            "customer_unique_id": "string",
            "customer_zip_code_prefix": "int",
            "customer_city": "string",
            "customer_state": "string",
        },
        key=("customer_id",),
        comment="Customers",
        added={"segment": "string"},
    ),
    Contract(
        "geolocation",
        {
            "geolocation_zip_code_prefix": "int",
            "geolocation_lat": "double",
            "geolocation_lng": "double",
            "geolocation_city": "string",
            "geolocation_state": "string",
        },
        key=("geolocation_zip_code_prefix",),
        comment="Coordinates by postal code prefix; the key repeats",
    ),
    Contract(
        "order_payments",
        {
            "order_id": "string",
            "payment_sequential": "int",
            "payment_type": "string",
            "payment_installments": "int",
            "payment_value": "double",
        },
        key=("order_id", "payment_sequential"),
        comment="Payments of orders",
    ),
    Contract(
        "order_reviews",
        {
            "review_id": "string",
            "order_id": "string",
            "review_score": "string",
            "review_comment_title": "string",
            "review_comment_message": "string",
            "review_creation_date": "timestamp",
            "review_answer_timestamp": "timestamp",
        },
        key=("review_id",),
        comment="Reviews of orders",
        multiline_text=True,
    ),
    Contract(
        "order_items",
        {
            "order_id": "string",
            "order_item_id": "int",
            "product_id": "string",
            "seller_id": "string",
            "shipping_limit_date": "timestamp",
            "price": "double",
            "freight_value": "double",
        },
        key=("order_id", "order_item_id"),
        comment="Items of orders",
    ),
    Contract(
        "orders",
        {
            "order_id": "string",
            "customer_id": "string",
            "order_status": "string",
            "order_purchase_timestamp": "timestamp",
            "order_approved_at": "timestamp",
            "order_delivered_carrier_date": "timestamp",
            "order_delivered_customer_date": "timestamp",
            "order_estimated_delivery_date": "timestamp",
        },
        key=("order_id",),
        comment="Orders",
        added={"total_order_value": "double"},
        partition=("purchase_month", "date_format(order_purchase_timestamp, 'yyyy-MM')"),
        cluster=("order_id",),
    ),
    Contract(
        "products",
        {
            "product_id": "string",
            "product_category_name": "string",
            "product_name_lenght": "int",
            "product_description_lenght": "int",
            "product_photos_qty": "int",
            "product_weight_g": "int",
            "product_length_cm": "int",
            "product_height_cm": "int",
            "product_width_cm": "int",
        },
        key=("product_id",),
        comment="Products",
    ),
    Contract(
        "sellers",
        {
            "seller_id": "string",
            "seller_zip_code_prefix": "int",
            "seller_city": "string",
            "seller_state": "string",
        },
        key=("seller_id",),
        comment="Sellers",
    ),
    Contract(
        "category_translation",
        {
            "product_category_name": "string",
            "product_category_name_english": "string",
        },
        key=("product_category_name",),
        comment="Category names in English",
    ),
)

# Names and types of the star schema.
STAR = _by_name(
    Contract(
        "dim_customer",
        {
            "customer_id": "string",
            "customer_unique_id": "string",
            "customer_zip_code_prefix": "string",
            "customer_city": "string",
            "customer_state": "string",
        },
        key=("customer_id",),
        comment="Customer dimension",
    ),
    Contract("dim_products", CLEAN["products"].columns, key=("product_id",), comment="Product dimension"),
    Contract(
        "dim_sellers",
        {
            "seller_id": "string",
            "seller_zip_code_prefix": "string",
            "seller_city": "string",
            "seller_state": "string",
        },
        key=("seller_id",),
        comment="Seller dimension",
    ),
    Contract(
        "dim_location",
        {
            "location_id": "string",
            "geolocation_zip_code_prefix": "string",
            "geolocation_city": "string",
            "geolocation_state": "string",
        },
        key=("location_id",),
        comment="Location dimension",
    ),
    Contract(
        "dim_coordinates",
        {
            "location_id": "string",
            "geolocation_lat": "string",
            "geolocation_lng": "string",
            "latitude": "double",
            "longitude": "double",
        },
        key=("location_id",),
        comment="Coordinates per source row; the key repeats",
    ),
    Contract(
        "dim_time",
        {
            "time_id": "date",
            "year": "int",
            "month": "int",
            "day": "int",
            "trimestre": "int",
            "weekday": "int",
            "week_number": "int",
            "is_weekend": "boolean",
        },
        key=("time_id",),
        comment="Calendar dimension",
    ),
    Contract(
        "fct_sales",
        {
            "sale_id": "string",
            "customer_id": "string",
            "product_id": "string",
            "seller_id": "string",
            "location_id": "string",
            "time_id": "date",
            "quantity": "int",
            "price": "money",
            "freight_value": "money",
            "payment_value": "money",
            "payment_installments": "int",
        },
        key=("sale_id",),
        comment="Sales fact: item x seller location x payment; the key repeats",
        foreign_keys=(
            ForeignKey("customer_id", "dim_customer", "customer_id"),
            ForeignKey("product_id", "dim_products", "product_id"),
            ForeignKey("seller_id", "dim_sellers", "seller_id"),
            ForeignKey("location_id", "dim_location", "location_id"),
            ForeignKey("time_id", "dim_time", "time_id"),
        ),
        partition=("sale_month", "date_format(time_id, 'yyyy-MM')"),
        cluster=("product_id",),
    ),
)
