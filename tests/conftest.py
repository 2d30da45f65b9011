import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


def pytest_collection_modifyitems(items):
    """Tests that use an Observation come last: the session they share cannot be shipped afterwards, and models that keep their training summary hold on to it."""
    items.sort(key=lambda item: "with_an_observation" in item.name)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


VALID = {
    "booking_id": "INN1",
    "no_of_adults": "2",
    "no_of_children": "1",
    "no_of_weekend_nights": "1",
    "no_of_week_nights": "2",
    "type_of_meal_plan": "Meal Plan 2",
    "required_car_parking_space": "0",
    "room_type_reserved": "Room_Type 1",
    "lead_time": "10",
    "arrival_year": "2018",
    "arrival_month": "3",
    "arrival_date": "10",
    "market_segment_type": "Offline",
    "repeated_guest": "0",
    "no_of_previous_cancellations": "1",
    "no_of_previous_bookings_not_canceled": "3",
    "avg_price_per_room": "100.5",
    "no_of_special_requests": "0",
    "booking_status": "Canceled",
}


@pytest.fixture
def make_rows(spark):
    """Raw booking rows, each a valid row with some values changed."""
    from sievework.specs import BOOKING

    def make(*changes):
        rows = [
            tuple({**VALID, "booking_id": f"INN{i}", **change}[c] for c in BOOKING.names)
            for i, change in enumerate(changes)
        ]
        return spark.createDataFrame(rows, BOOKING.raw_schema)

    return make


class Statements:
    """What the session's own listener knows of the statements run since this was made."""

    def __init__(self, spark):
        self.spark = spark
        self.before = {e.executionId() for e in self._all()}

    def _all(self):
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.store = self.spark._jsparkSession.sharedState().statusStore()
        found = self.store.executionsList()
        return [found.apply(i) for i in range(found.size())]

    def new(self):
        return [e for e in self._all() if e.executionId() not in self.before]

    def nodes(self):
        for e in self.new():
            nodes = self.store.planGraph(e.executionId()).allNodes()
            yield from ((e, nodes.apply(i)) for i in range(nodes.size()))

    def scans_of(self, name):
        """Scans of files whose node names the table or whose description names the path."""
        return [n for _, n in self.nodes() if n.name().startswith("Scan ") and (name in n.name() or name in n.desc())]

    def jobs(self):
        return sum(e.jobs().size() for e in self.new())

    def shuffled_bytes(self):
        total = 0
        store = self.spark.sparkContext._jsc.sc().statusStore()
        for e in self.new():
            ids = e.stages().toList()
            for i in range(ids.size()):
                attempt = store.lastStageAttempt(ids.apply(i))
                total += attempt.shuffleWriteBytes()
        return total


@pytest.fixture
def statements(spark):
    return lambda: Statements(spark)
