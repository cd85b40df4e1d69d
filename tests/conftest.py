import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from comanda.session import SESSION_CONF  # noqa: E402
from comanda.sources.operational import Tables  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[8]").appName("tests")
    conf = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": str(home / "warehouse"),
        "spark.checkpoint.dir": str(home / "checkpoints"),
        "spark.driver.memory": "6g",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Hand-made tables with the awkward rows: an order without delivery, without lines, without restaurant, by an
    admin, to an unknown zone, on the way, with a repeated product; a product without category; a month without
    orders."""

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return Tables(
        categories=frame([(1, "Pizza", "d", "P"), (2, "Soup", "d", "S")],
                         "id long, name string, description string, icon string"),
        restaurants=frame([(5, "R5", "a", "z1", 1.0, 1.0, 4.5), (9, "R9", "b", "z2", 2.0, 2.0, 3.0)],
                          "id long, name string, address string, zone string, lat double, lon double, rating double"),
        products=frame([(10, "Big", 10.0, True, 1), (20, "Hot", 4.5, False, 2), (30, "Big", 7.25, True, 2),
                        (40, "Lost", 1.0, True, 99)],
                       "id long, name string, price double, available boolean, category_id long"),
        users=frame([(1, "Ana", "a@x", "customer", "z1", 1.0, 1.0), (2, "Ben", "b@x", "admin", "z1", 1.0, 1.0),
                     (3, "Eva", "e@x", "customer", "z2", 2.0, 2.0)],
                    "id long, name string, email string, role string, zone string, lat double, lon double"),
        couriers=frame([(7, "C7", "moto", "z1"), (8, "C8", "carro", "nowhere")],
                       "id long, name string, vehicle string, base_zone string"),
        orders=frame(
            [(100, 1, 5, "2025-01-10 00:30:00", "completed", 10.10, "card"),
             (101, 2, 5, "2025-01-10 12:00:00", "completed", 20.20, "cash"),
             (102, 3, 9, "2025-01-11 23:59:59", "delivering", 30.30, "card"),
             (103, 1, None, "2025-03-05 15:00:00", "pending", 0.0, "wallet"),
             (104, 3, 9, "2025-03-06 18:00:00", "completed", 5.05, "card"),
             (105, 3, 5, "2025-03-06 18:30:00", "cancelled", 1.0, "card")],
            "id long, user_id long, restaurant_id long, order_ts string, status string, total double, "
            "payment_method string",
        ).selectExpr("id", "user_id", "restaurant_id", "cast(order_ts as timestamp) order_ts", "status", "total",
                     "payment_method"),
        order_items=frame(
            [(1, 100, 10, 2, 5.0, 10.0), (2, 100, 20, 1, 4.5, 4.5), (3, 100, 10, 1, 6.0, 6.0),
             (4, 101, 10, 1, 10.0, 10.0), (5, 102, 30, 3, 7.25, 21.75), (6, 102, 20, 1, 4.5, 4.5),
             (7, 104, 30, 1, 7.25, 7.25), (8, 104, 40, 1, 1.0, 1.0), (9, 105, 20, 4, 4.5, 18.0)],
            "id long, order_id long, product_id long, quantity int, unit_price double, line_total double"),
        deliveries=frame(
            [(100, 7, "z1", 1.25, 10, "2025-01-10 00:41:59"), (101, None, "z1", 0.5, 5, "2025-01-10 11:59:01"),
             (102, 8, "z2", 3.0, 20, None), (104, 7, "elsewhere", None, 12, "2025-03-06 18:20:00")],
            "order_id long, courier_id long, dest_zone string, distance_km double, eta_min int, delivered_ts string",
        ).selectExpr("order_id", "courier_id", "dest_zone", "distance_km", "eta_min",
                     "cast(delivered_ts as timestamp) delivered_ts"),
        zones=frame([(1, "z1", "Zone 1", 1.0, 1.0), (2, "z2", "Zone 2", 2.0, 2.0)],
                    "location_key int, zone string, zone_name string, lat double, lon double"),
    )
