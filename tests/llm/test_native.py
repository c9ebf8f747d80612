import random
import zlib
from collections import Counter

from tidemark.llm import chat, sharding

from .conftest import EDGE_IDS, EDGE_TEXTS

CONV = "conv_id long, turn int, role string, text string, part int, perspective string"


def test_views_of_each_speaker(spark):
    rows = [(1, 0, "system", "be kind", 5, "x"), (1, 1, "ann", "hi <|im_end|>", 5, "x"), (1, 2, "bob", None, 5, "x"), (1, 3, "ann", "bye", 5, "x"), (2, 0, "system", "alone", 5, "x"), (None, None, None, "who", 5, "x")]
    got = {(r.conv_id, r.perspective): r for r in chat.rotate(spark.createDataFrame(rows, CONV)).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    ann = got[1, "ann"]
    assert ann.text == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    spans = [tuple(map(int, s.split(":"))) for s in ann.mask_spans.split(",")]
    assert [ann.text[a:b] for a, b in spans] == ["hi < |im_end|><|im_end|>", "bye<|im_end|>"]
    assert ann.mask_chars == sum(b - a for a, b in spans) and (ann.n_turns, ann.n_own) == (4, 2)


def test_long_dialogues_come_in_parts(spark):
    df = spark.createDataFrame([(1, t, "ann" if t % 3 else "bob", f"t{t}", 0, "") for t in range(200)] * 2, CONV)
    whole = chat.rotate(df).filter("perspective = 'bob'").collect()
    got = chat.rotate(df, part_turns=100).filter("perspective = 'bob'").orderBy("part").collect()
    assert [(r.part, r.n_turns) for r in got] == [(k, 100) for k in range(4)] and len(whole) == 1 and whole[0].text == "".join(r.text for r in got)
    moved = [f"{r.part_start + int(a)}:{r.part_start + int(b)}" for r in got for a, b in (x.split(":") for x in r.mask_spans.split(","))]
    assert moved == whole[0].mask_spans.split(",") and whole[0].mask_chars == sum(r.mask_chars for r in got)
    end = 0
    for r in got:
        assert r.part_start == end
        end += len(r.text)
    assert chat.rotate(df.limit(0)).count() == 0
    # a conversation whose rows all share one turn number, or have none
    for turn in (7, None):
        same = spark.createDataFrame([(None, turn, f"s{k % 2}", f"t{k}", 0, "") for k in range(250)], CONV)
        parts = chat.rotate(same, part_turns=60).collect()
        assert Counter((r.perspective, r.n_turns) for r in parts) == {("s0", 60): 4, ("s0", 10): 1, ("s1", 60): 4, ("s1", 10): 1}
        for r in parts:
            assert all(r.text[int(a) :].startswith("t") and r.text[int(b) - 10 : int(b)] == "<|im_end|>" for a, b in (x.split(":") for x in r.mask_spans.split(",") if x))


def test_no_window_carries_texts(spark):
    """A dialogue without an id that is a third of all rows: parts start where the ones before them end, and windows are narrow."""
    rows = [(None, k, f"s{k % 3}", f"turn {k}", 0, "") for k in range(300)] + [(k % 90, k, "ann", f"t{k}", 0, "") for k in range(600)]
    got = chat.rotate(spark.createDataFrame(rows, CONV), part_turns=50)
    for who in ("s0", "s1", "s2"):
        at = 0
        for r in sorted((r for r in got.collect() if r.conv_id is None and r.perspective == who), key=lambda r: r.part):
            assert r.part_start == at
            at += len(r.text)
        assert at > 0
    windows = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in line]
    assert windows and not any("array_join" in line for line in windows)


def check(df, shards=16):
    got = sharding.shard(df, shards=shards).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    return got


def test_shards(edge, empty, make):
    got = check(edge)
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in zip(EDGE_IDS, EDGE_TEXTS, strict=True))
    assert check(empty) == []
    check(make([str(k) for k in range(1003)], parts=7))
    # several ranges of slots in a shard
    sharding.RANGE_ROWS, kept = 20, sharding.RANGE_ROWS
    try:
        check(make([str(k) for k in range(1003)], parts=7))
    finally:
        sharding.RANGE_ROWS = kept


def test_hypergeometric_draws():
    rng = random.Random(1)
    for good, bad, n in ((5, 7, 4), (30, 10, 25), (1, 1, 1), (0, 5, 3), (5, 0, 3)):
        draws = [sharding.hypergeometric(rng, good, bad, n) for _ in range(4000)]
        assert all(max(0, n - bad) <= d <= min(n, good) for d in draws)
        assert abs(sum(draws) / 4000 - n * good / (good + bad)) < 0.1
    assert abs(sharding.hypergeometric(rng, 10**9, 15 * 10**9, 10**6) - 62500) < 2500


def test_every_shard_is_as_likely():
    rng, seen = random.Random(2), Counter()
    for _ in range(2000):
        room = [3, 3, 2]
        first = sharding.deal(rng, 4, room)
        assert sum(first) == 4 and sharding.deal(rng, 4, room) == [3 - first[0], 3 - first[1], 2 - first[2]]
        seen.update(dict(enumerate(first)))
    assert abs(seen[0] / 2000 - 1.5) < 0.08 and abs(seen[2] / 2000 - 1.0) < 0.08
