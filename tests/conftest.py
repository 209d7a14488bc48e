import gzip
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


class Snapshot:
    """Writes snapshot files into a folder."""

    def __init__(self, root):
        self.root = root

    def records(self, entity, date, records, part=0):
        folder = self.root / "data" / f"{entity}s" / f"updated_date={date}"
        folder.mkdir(parents=True, exist_ok=True)
        with gzip.open(folder / f"part_{part:03}.gz", "wt", encoding="utf-8") as out:
            for record in records:
                out.write((record if isinstance(record, str) else json.dumps(record)) + "\n")

    def merged(self, entity, date, ids):
        folder = self.root / "data" / "merged_ids" / f"{entity}s"
        folder.mkdir(parents=True, exist_ok=True)
        with gzip.open(folder / f"{date}.csv.gz", "wt", encoding="utf-8") as out:
            out.write("merge_date,id,merge_into_id\n")
            for old, new in ids:
                out.write(f"{date},{old},{new}\n")


@pytest.fixture
def snapshot(tmp_path):
    return Snapshot(tmp_path / "snapshot")
