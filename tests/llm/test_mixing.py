from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourtally.llm import mixing


def earliest_deadline_first(parts, slots):
    """The schedule by hand: the source of each slot."""
    done, out = dict.fromkeys(parts, 0), []
    for t in range(slots):
        open_ = [
            (-(-(done[k] + 1) * slots // q), k) for k, q in sorted(parts.items()) if done[k] * slots // q <= t
        ]
        out.append(min(open_)[1])
        done[out[-1]] += 1
    return out


def by_hand(rows, parts, slots, block):
    """Position of every (source, rank)."""
    import hashlib

    queues = {}
    for source, doc_id in rows:
        queues.setdefault("" if source is None else f"s{source}", []).append(doc_id)
    for ids in queues.values():
        ids.sort(key=lambda i: (hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), -1 if i is None else i))
    order, schedule = [], earliest_deadline_first(parts, slots)
    while any(queues.values()):
        for key in schedule:
            order += [(key, i) for i in queues[key][:block]]
            queues[key] = queues[key][block:]
    return order


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 1}, {"a": 97, "b": 1, None: 2}])
def test_against_a_schedule_by_hand(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "STRETCH", 4)
    rows = [(s, i) for i, s in enumerate(["a"] * 70 + ["b"] * 31 + ["c"] * 9 + [None] * 5)] + [("a", None)]
    frame = spark.createDataFrame(rows, "source string, doc_id long")
    found = sorted((r.position, "" if r.source is None else f"s{r.source}", r.doc_id) for r in mixing.mixed(frame, weights, 40, 3).collect())
    sizes = frame.groupBy(mixing._key(F.col("source")).alias("key")).agg(F.count("*").alias("n"))
    given = spark.createDataFrame([("" if k is None else f"s{k}", v) for k, v in weights.items()], "key string, weight long")
    weighted = sizes.join(given, "key", "left").fillna({"weight": 0})
    parts = {r.key: r.q for r in mixing.parts(weighted, 40).collect()}
    assert sum(parts.values()) == 40 and min(parts.values()) >= 1
    assert [p for p, _, _ in found] == list(range(len(rows)))
    assert [(k, i) for _, k, i in found] == by_hand(rows, parts, 40, 3)


def test_less_than_a_block_away(spark):
    shares = spark.createDataFrame([("a", 9, 431), ("b", 9, 300), ("c", 9, 200), ("d", 9, 68), ("e", 9, 1)], "key string, n long, q long")
    rows = sorted(mixing.schedule(shares).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(1000))
    for r in rows:
        for done, q in zip(r.done, r.all_q, strict=True):
            assert abs(done - r.slot * q / 1000) < 1


def test_sources_in_groups_by_hand(spark):
    """Eight slots, two singles and two groups: every step once more by hand."""
    weights = {f"s{i:02}": w for i, w in enumerate([40, 30, 9, 9, 9, 9, 9, 9, 9, 9])}
    rows = [(source, 1000 * i + k) for i, source in enumerate(weights) for k in range(4 + i)]
    frame = spark.createDataFrame(rows, "source string, doc_id long")
    found = mixing.mixed(frame, weights, 8, 2).collect()
    ordered = sorted(weights.items(), key=lambda x: (-x[1], x[0]))
    groups = {"/0": [k for n, (k, _) in enumerate(ordered, 1) if n > 2 and n % 2 == 0], "/1": [k for n, (k, _) in enumerate(ordered, 1) if n > 2 and n % 2]}
    entries = {f"s{k}": w for k, w in ordered[:2]} | {g: sum(weights[k] for k in members) for g, members in groups.items()}

    def split(members):
        spare, total = 8 - len(members), sum(members.values())
        whole = {k: w * spare // total for k, w in members.items()}
        rest = sorted(members, key=lambda k: (-(members[k] * spare % total), k))[: spare - sum(whole.values())]
        return {k: 1 + whole[k] + (k in rest) for k in members}

    top = split(entries)
    inner = {g: earliest_deadline_first(split({f"s{k}": weights[k] for k in members}), 8) for g, members in groups.items()}
    at, queues, order = {}, {}, []
    for source in weights:
        ranked_ids = by_hand([(source, d) for s, d in rows if s == source], {f"s{source}": 1}, 1, 2)
        queues[f"s{source}"] = [d for _, d in ranked_ids]
    while any(queues.values()):
        for key in earliest_deadline_first(top, 8):
            if key in groups:
                k = at.get(key, 0)
                at[key] = k + 1
                key = inner[key][k % 8]
            order += queues[key][:2]
            queues[key] = queues[key][2:]
    assert [r.doc_id for r in sorted(found, key=lambda r: r.position)] == order
    assert sorted(r.position for r in found) == list(range(len(rows)))


@pytest.mark.parametrize(("sources", "slots"), [(1001, 1000), (20_000, 200), (300, 12)])
def test_more_sources_than_slots(spark, sources, slots):
    """Every document once, in the order of slots, each block in a slot of its own."""
    heavy = {"s0": 9 * sources, "s1": 3 * sources}
    weights = {f"s{i}": heavy.get(f"s{i}", 1 + i % 7) for i in range(sources)}
    frame = spark.range(sources * 3).selectExpr(f"'s' || id % {sources} AS source", "id AS doc_id")
    more = spark.range(4 * slots).selectExpr("'s' || id % 2 AS source", "id + 10000000 AS doc_id")
    found = mixing.mixed(frame.unionByName(more), weights, slots, 1).collect()
    assert len(found) == sources * 3 + 4 * slots
    assert sorted(r.position for r in found) == list(range(len(found)))
    assert len({r.mix_slot for r in found}) == len(found)
    by_place = sorted(found, key=lambda r: r.position)
    assert all(a.mix_slot < b.mix_slot for a, b in zip(by_place, by_place[1:], strict=False))


def test_odd_rows(odd_docs, no_docs):
    found = mixing.mixed(odd_docs)
    assert found.count() == odd_docs.count()
    assert sorted(r.mix_slot is not None for r in found.collect()) == [True] * odd_docs.count()
    assert found.drop("mix_block", "mix_slot", "position").columns == [c for c in odd_docs.columns if c != "position"]
    assert sorted(r.position for r in found.collect()) == list(range(odd_docs.count()))
    assert mixing.mixed(no_docs).count() == 0


def test_no_python_in_the_plan(odd_docs):
    plan = mixing.mixed(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
