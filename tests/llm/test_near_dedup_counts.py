"""Counting what classes of long lists share."""

import random
from collections import Counter

import pyarrow as pa

from tideline.llm import near_dedup


def _texts():
    rng = random.Random(3)
    docs = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(80)))) for i in range(400)]
    sets = {i: set(zip(t.split(), t.split()[1:])) or ({t} if t else set()) for i, t in docs}
    return docs, sets


def test_shared_shingles_against_brute_force(spark, monkeypatch):
    docs, sets = _texts()
    odd = [i for i in sets if i % 2]
    seen = Counter(x for i in odd for x in sets[i])
    expected = {(i, v): sum(seen[x] > 1 for x in sets[i]) for i in odd for v in (1, 2)}
    members = spark.createDataFrame([(i, len(sets[i]), v) for i, v in expected], "id long, n long, v long")
    texts = spark.createDataFrame(docs, "id long, text string").repartition(3)
    for part in (100, near_dedup.PART_SHINGLES):  # many parts, one part
        monkeypatch.setattr(near_dedup, "PART_SHINGLES", part)
        assert {(r.id, r.v): r.shared for r in near_dedup._can_link(members, texts, 2).collect()} == expected


def test_a_task_sends_rows_by_part_not_by_shingle():
    docs, sets = _texts()
    batch = pa.RecordBatch.from_pydict({"id": [i for i, _ in docs], "text": [t for _, t in docs]})
    sent = list(near_dedup._gathered(2, 4)(iter([batch, batch.slice(0, 0)])))
    seen = Counter(x for s in sets.values() for x in s)
    assert sum(b.num_rows for b in sent) == 4
    assert sum(len(x) for b in sent for x in b.column("s").to_pylist()) == sum(n == 1 for n in seen.values())
    assert sum(len(x) for b in sent for x in b.column("several").to_pylist()) == sum(n > 1 for n in seen.values())
    assert list(near_dedup._gathered(2, 4)(iter([]))) == []
