"""Doubles of remote services."""

import json
import os
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


class FileBatches:
    """Batches as JSON lines in a folder, answered by a function: for tests and offline runs."""

    def __init__(self, root: str, answer):
        self.root, self.answer = root.rstrip("/"), answer

    def submit(self, requests) -> str:
        # the same requests are the same batch
        requests = requests.persist()
        batch = f"batch-{requests.agg(F.bit_xor(F.xxhash64('custom_id', 'params'))).first()[0] or 0:x}"
        answer = F.udf(lambda p: json.dumps(self.answer(json.loads(p))), "string")
        requests.select("custom_id", F.lit("succeeded").alias("result_type"), F.lit("tool_use").alias("stop_reason"), answer("params").alias("payload")).write.mode("overwrite").json(f"{self.root}/{batch}")
        return batch

    def state(self, batch: str) -> str:
        return "ended"

    def results(self, spark: SparkSession, batch: str):
        return spark.read.schema("custom_id string, result_type string, stop_reason string, payload string").json(f"{self.root}/{batch}")


class Folder:
    """A batch service that keeps what it gets in a folder, answers in pages of two, and can be told to fail."""

    def __init__(self, root):
        self.root = root

    def submit(self, requests, name):
        batch = f"svc-{name}"
        with open(f"{self.root}/log", "a") as f:
            f.write(f"{os.getpid()} {name}\n")
        with open(f"{self.root}/{batch}", "w") as f:
            json.dump(requests, f)
        if os.path.exists(f"{self.root}/die"):
            os.remove(f"{self.root}/die")
            raise RuntimeError("lost after the service took the chunk")
        return batch

    def find(self, name):
        return f"svc-{name}" if os.path.exists(f"{self.root}/svc-{name}") else None

    def _requests(self, batch):
        with open(f"{self.root}/{batch}") as f:
            return json.load(f)

    def pages(self, batch):
        n = len(self._requests(batch))
        ready = os.path.exists(f"{self.root}/ready")
        return (n + 1) // 2 if ready else min(1, n), ready

    def page(self, batch, n):
        return [{"custom_id": r["custom_id"], "result_type": "succeeded", "stop_reason": "tool_use", "payload": json.dumps({"n": r["params"]["n"]})} for r in self._requests(batch)[2 * n : 2 * n + 2]]


def folder_service():
    return Folder(os.environ["FOLDER_SERVICE"])


def search_service():
    """A search service over made-up records: (query, skip, limit) -> rows; it refuses more keys than its limit and logs what it is asked."""
    root = os.environ["FOLDER_SERVICE"]

    def fetch(query, skip, limit):
        source, field, keys = re.match(r"search (\w+) where ([\w.]+) in (\[[^\]]*\])", query).groups()
        keys, span = json.loads(keys), re.search(r"in \[(\d+):(\d+)\]", query)
        assert len(keys) <= {"family_id": 500, "id": 200, "researchers.id": 200}[field]
        with open(f"{root}/asked", "a") as f:
            f.write(f"{len(keys)} {skip}\n")
        if field == "family_id":  # three members a family, of the years 2000 to 2002
            rows = [{"id": f"{k}-{m}", "family_id": k, "publication_year": 2000 + m} for k in keys for m in range(3) if not span or int(span[1]) <= 2000 + m <= int(span[2])]
        elif field == "id":  # publication k is by researchers k % 300 and 7
            counts = {}
            for k in keys:
                for r in {int(k) % 300, 7}:
                    counts[r] = counts.get(r, 0) + 1
            rows = [{"id": f"r{r}", "first_name": "A", "last_name": str(r), "count": n} for r, n in counts.items()]
            return rows[:limit]
        else:
            rows = [{"id": f"p{j}", "year": 2000} for k in keys for j in (int(k[1:]), int(k[1:]) + 1)]
        return rows[skip : skip + limit]

    return fetch


def year_service():
    def fetch(query, skip, limit):
        span = re.search(r"year in \[(\d+):(\d+)\]", query)
        with open(os.environ["FOLDER_SERVICE"] + "/asked", "a") as f:
            f.write(query + "\n")
        rows = [{"id": str(y), "year": y} for y in range(1990, 2030) if not span or int(span[1]) <= y <= int(span[2])]
        return rows[skip : skip + limit]

    return fetch
