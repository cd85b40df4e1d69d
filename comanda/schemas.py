"""Warehouse tables: columns, types and comments in one place, used for DDL and for writing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    comment: str = ""


@dataclass(frozen=True)
class Table:
    name: str
    comment: str
    columns: tuple[Column, ...]
    partitioned_by: tuple[str, ...] = ()

    def conform(self, df: DataFrame) -> DataFrame:
        """The table's columns in order, with its types and comments; a missing column raises."""
        return df.select(*[
            F.col(c.name).cast(c.type).alias(c.name, metadata={"comment": c.comment} if c.comment else {})
            for c in self.columns
        ])

    def ddl(self, database: str) -> str:
        def column(c: Column) -> str:
            return f"`{c.name}` {c.type}" + (f" COMMENT '{c.comment}'" if c.comment else "")

        columns = ", ".join(map(column, self.columns))
        text = f"CREATE TABLE IF NOT EXISTS `{database}`.`{self.name}` ({columns}) USING ORC"
        if self.partitioned_by:
            text += f" PARTITIONED BY ({', '.join(self.partitioned_by)})"
        return text + f" COMMENT '{self.comment}' TBLPROPERTIES ('orc.compress'='SNAPPY')"


def _table(name: str, comment: str, text: str, partitioned_by: tuple[str, ...] = ()) -> Table:
    """Columns from lines of ``name type [comment]``."""
    columns = []
    for line in text.strip().splitlines():
        name_, type_, *rest = line.split(maxsplit=2)
        columns.append(Column(name_, type_, rest[0].strip() if rest else ""))
    return Table(name, comment, tuple(columns), partitioned_by)


DIM_DATE = _table("dim_date", "calendar days", """
    date_key INT yyyyMMdd
    full_date DATE
    year INT
    quarter INT
    semester INT 1 = January to June, 2 = July to December
    month INT
    month_name STRING
    week_of_year INT ISO week
    day_of_month INT
    day_of_week INT 1 = Sunday to 7 = Saturday
    day_name STRING
    is_weekend BOOLEAN Saturday or Sunday
""")
DIM_TIME = _table("dim_time", "hours of the day", """
    time_key INT hour 0 to 23
    hour INT
    time_label STRING 00:00 to 23:00
    time_of_day STRING band of the day
""")
DIM_CATEGORY = _table("dim_category", "product categories", """
    category_key BIGINT surrogate key
    category_id BIGINT natural key
    category_name STRING
    description STRING
    icon STRING
""")
DIM_PRODUCT = _table("dim_product", "products with their current price (type 1)", """
    product_key BIGINT surrogate key
    product_id BIGINT natural key
    product_name STRING
    category_key BIGINT key of dim_category
    category_name STRING copied from dim_category
    unit_price DOUBLE
    available BOOLEAN
""")
DIM_CUSTOMER = _table("dim_customer", "users with the role customer", """
    customer_key BIGINT surrogate key
    user_id BIGINT natural key
    user_name STRING
    email STRING
    zone STRING zone of residence
    lat DOUBLE
    lon DOUBLE
""")
DIM_RESTAURANT = _table("dim_restaurant", "restaurants", """
    restaurant_key BIGINT surrogate key
    restaurant_id BIGINT natural key
    rest_name STRING
    address STRING
    zone STRING
    lat DOUBLE
    lon DOUBLE
    rating DOUBLE
""")
DIM_LOCATION = _table("dim_location", "delivery zones", """
    location_key INT surrogate key
    zone STRING zone code
    zone_name STRING
    lat DOUBLE latitude of the centre
    lon DOUBLE longitude of the centre
""")
DIM_COURIER = _table("dim_courier", "couriers", """
    courier_key BIGINT surrogate key
    courier_id BIGINT natural key
    courier_name STRING
    vehicle STRING
    base_zone STRING
""")
FACT_ORDERS = _table("fact_orders", "one row per order", """
    order_key BIGINT equal to the order id
    order_id BIGINT natural key
    date_key INT key of dim_date
    time_key INT key of dim_time
    customer_key BIGINT key of dim_customer, NULL for other roles
    restaurant_key BIGINT key of dim_restaurant
    location_key INT key of dim_location, -1 without delivery
    courier_key BIGINT key of dim_courier, -1 without delivery
    status STRING
    payment_method STRING
    total DOUBLE amount of the order
    item_count BIGINT lines of the order
    distance_km DOUBLE NULL without delivery
    eta_min INT estimated minutes
    delivery_time_min INT minutes from order to delivery, NULL on the way
    is_delivered BOOLEAN status completed or delivering
    year INT
    month INT
""", ("year", "month"))
FACT_ORDER_ITEMS = _table("fact_order_items", "one row per order line", """
    item_key BIGINT surrogate key
    order_id BIGINT natural key of the order
    date_key INT key of dim_date
    time_key INT key of dim_time
    product_key BIGINT key of dim_product
    category_key BIGINT key of dim_category
    restaurant_key BIGINT key of dim_restaurant
    customer_key BIGINT key of dim_customer
    quantity INT
    unit_price DOUBLE
    line_total DOUBLE
    year INT
    month INT
""", ("year", "month"))

DIMENSIONS = (DIM_DATE, DIM_TIME, DIM_CATEGORY, DIM_PRODUCT, DIM_CUSTOMER, DIM_RESTAURANT, DIM_LOCATION, DIM_COURIER)
FACTS = (FACT_ORDERS, FACT_ORDER_ITEMS)
WAREHOUSE = {table.name: table for table in DIMENSIONS + FACTS}
