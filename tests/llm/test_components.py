"""Connected components: few links take no rounds, more links than a task holds take as many tasks.

And what a task leaves free in its worker, the next one gives back.
"""

import random
import re

import pyarrow as pa
import pytest

from maskline.llm import groups
from maskline.llm.common import map_rows
from maskline.llm.groups import components


def expected(links):
    label = {x: x for link in links if link[0] != link[1] and None not in link for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in label and b in label and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def some_links():
    r = random.Random(5)
    chain = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)]
    star = [("s00", f"s{i:02}") for i in range(1, 20)]
    loose = [(f"x{r.randrange(80):02}", f"x{r.randrange(80):02}") for _ in range(40)]
    links = chain + star + loose + [("y", "y"), ("é", "z"), ("z", "é"), ("n007", None), star[0]]
    r.shuffle(links)
    return links


@pytest.mark.parametrize("most", [100_000, 50, 3])
def test_equal_however_many_tasks(spark, monkeypatch, most):
    monkeypatch.setattr(groups, "TASK_LINKS", most)
    links = some_links()
    for kind, values in (("string", links), ("binary", [tuple(x and x.encode() for x in p) for p in links])):
        found = components(spark.createDataFrame(values, f"a {kind}, b {kind}").repartition(7)).collect()
        assert len({bytes(r["node"]) if kind == "binary" else r["node"] for r in found}) == len(found)
        plain = (lambda x: bytes(x).decode()) if kind == "binary" else str
        assert {plain(r["node"]): plain(r["label"]) for r in found} == expected(links)
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_few_links_take_no_rounds(spark):
    """A round is several shuffles of many tasks over tiny tables, whose pages make the heap grow."""
    context = spark.sparkContext
    links = spark.createDataFrame(some_links(), "a string, b string").repartition(7)
    context.setJobGroup("few links", "components")
    try:
        components(links)
        jobs = context.statusTracker().getJobIdsForGroup("few links")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 4


def test_task_gives_back_what_the_last_one_left(spark):
    class Here:
        """A table whose tasks run in this process."""

        sparkSession = spark

        def mapInArrow(self, run, schema):
            return run

    def held():
        with open("/proc/self/status") as status:
            return int(re.search(r"RssAnon:\s+(\d+)", status.read())[1]) // 1024

    task = map_rows(Here(), lambda texts: ([held()],), "mb bigint")
    blocks = [bytes([1]) * 60_000 for _ in range(4_000)]  # small enough that the allocator keeps what is freed
    stay = blocks[::40]
    del blocks
    left = held()
    (out,) = task(iter([pa.RecordBatch.from_arrays([pa.array(["x"])], names=["text"])]))
    assert len(stay) == 100 and out["mb"][0].as_py() < left - 150
