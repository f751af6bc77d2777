"""The query of operator 9 against a plain version of plan, cuts and order; only row hashes are taken from Spark."""

import math
import re
from collections import Counter, defaultdict

from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tokenloom.llm import common, mixing

TARGET, LIMIT = 0.97, 4.0


def _plain_exponent(shares: list[float]) -> float:
    """The least exponent at which entropy is down to the target, raised to 1 at most where a source repeats too often."""

    def moments(e: float) -> tuple[float, float]:
        powers = [p**e for p in shares]
        z = sum(powers)
        return -sum(x / z * math.log(x / z) for x in powers) / math.log(len(shares)), max(x / z / p for x, p in zip(powers, shares))

    def least(low: float, high: float, holds) -> float:
        if holds(low):
            return low
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if holds(middle) else (middle, high)
        return high

    e = least(0.0, 8.0, lambda x: moments(x)[0] <= TARGET)
    return least(e, 1.0, lambda x: moments(x)[1] <= LIMIT) if e < 1 else e


def test_query_is_the_plain_mixture(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 8)
    docs = common.table(spark, SMALL, "documents", "doc_id", "text", "source")
    key = mixing._key(42)
    rows = docs.select("*", key.alias("key"), mixing._place(key).alias("place")).collect()
    tokens = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    totals, counts = Counter(), Counter()
    for r, n in zip(rows, tokens):
        totals[r.source] += n
        counts[r.source] += 1
    budget = sum(totals.values())
    spoken = {s: t / budget for s, t in totals.items() if t}
    exponent = _plain_exponent(list(spoken.values()))
    z = sum(p**exponent for p in spoken.values())
    plan = {r.source: r for r in mixing.mixing_plan(docs, budget, TARGET, LIMIT).collect()}
    assert set(plan) == set(totals)
    uses, blocks = [], {}
    for source, row in plan.items():
        weight = spoken[source] ** exponent / z if source in spoken else 0.0
        epochs = weight * budget / totals[source] if totals[source] else 1.0
        # The exponent is found to its sixth decimal.
        assert math.isclose(row.weight, weight, abs_tol=1e-4) and math.isclose(row.epochs, epochs, rel_tol=1e-4)
        whole, number = math.floor(row.epochs), -(-counts[source] // 8)
        rest = math.floor((row.epochs - whole) * totals[source])
        spent, stopped = 0, False
        own = sorted(((r.key % number, r.place, r.doc_id, n) for r, n in zip(rows, tokens) if r.source == source), key=lambda x: x[:2])
        places = defaultdict(int)
        for block, place, _, n in own:
            places[block, place] += n
        taken = set()
        for at in sorted(places):
            stopped = stopped or spent + places[at] > rest
            spent += places[at]
            if not stopped:
                taken.add(at)
        for block, place, doc, n in own:
            blocks[source, doc] = block
            uses += [(doc, source, n, e) for e in range(whole + ((block, place) in taken))]
    found = contract.queries()["op9_mixing"](spark, SMALL).collect()
    assert Counter(uses) == Counter((r.doc_id, r.source, r.tokens, r.epoch) for r in found)
    # Every epoch of a source has its own stretch of the order, and its blocks stand together in it.
    turns = defaultdict(list)
    for r in sorted(found, key=lambda r: r.mix_order):
        span = math.ceil(plan[r.source].epochs)
        assert r.epoch / span <= r.mix_order < (r.epoch + 1) / span
        turns[r.source, r.epoch].append(blocks[r.source, r.doc_id])
    for order in turns.values():
        runs = [b for b, before in zip(order, [None, *order]) if b != before]
        assert len(runs) == len(set(runs))
    assert sum(r.tokens for r in found) <= budget
