"""Documents over many splits against the reader of whole files and against the JSON library."""
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import large_json as lj, readers as rd


def odd_text(rnd):
    return "".join(rnd.choice(['{', '}', '[', ']', '"', "\\", ",", ":", "é", "日", " ", "\n", "a", '"result":[', "}}", '\\"']) for _ in range(rnd.randint(0, 12)))


def document(rnd, n, layout):
    def value(deep=0):
        kind = rnd.randint(0, 5 if deep < 3 else 3)
        if kind == 4:
            return [value(deep + 1) for _ in range(rnd.randint(0, 3))]
        if kind == 5:
            return {odd_text(rnd): value(deep + 1) for _ in range(rnd.randint(0, 3))}
        return [odd_text(rnd), rnd.randint(-5, 5), None, True][kind]

    plain = [rnd.choice([1, "s}", None, ["x"], []]) for _ in range(rnd.randint(0, 2))] if rnd.random() < 0.3 else []
    items = [{"name": f"n{i}{odd_text(rnd)}", "use": i, "x": value(), "star": rnd.choice([4, 5, "5"])} for i in range(n)] + plain
    first = rnd.choice([{"s": []}, [1, [{"name": "no"}]], "text", 7, {"s": [{"name": "no"}]}])
    result = {"plain": items, "second": [first, items], "third": [first, 1, items], "scalars": [1, 2, *items], "four": [first, items, [{"name": "no"}]]}[layout]
    head = {"title": "t" + odd_text(rnd), "a}b": 1}
    tail = {"more": [{"name": "no"}], "deep": {"result": [{"name": "no"}]}, "end": None}
    return {**head, "result": result, **tail} if rnd.random() < 0.5 else {**tail, "result": result, **head}


@pytest.mark.parametrize("layout", ["plain", "second", "third", "scalars", "four"])
def test_many_splits_equal_the_whole(spark, tmp_path, layout):
    rnd = random.Random(layout)
    for i, n in enumerate((0, 1, 30, 120)):
        (tmp_path / f"{i}.json").write_text(json.dumps(document(rnd, n, layout), ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1])))
    small = rd.scan_documents(spark, str(tmp_path))
    for size in (64, 1000) if layout == "second" else (300,):
        large = lj.scan_large_documents(spark, str(tmp_path), split_bytes=size)
        assert large.columns == small.columns
        assert sorted(map(tuple, large.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)
    if layout == "second":
        splits = lj.read_splits(spark, str(tmp_path), 1000)
        assert splits.groupBy("file").count().agg(F.max("count")).first()[0] > 8 and small.count() >= 151


def test_states_combine_at_any_cut():
    rnd = random.Random(9)
    for _ in range(200):
        content = json.dumps(document(rnd, 5, rnd.choice(["plain", "second"])), ensure_ascii=False).encode()
        ends = [i + 1 for i, c in enumerate(content) if c == 125]
        cuts = [0, *sorted(rnd.sample(ends[:-1], min(4, len(ends) - 1))), len(content)]
        stack, within, items, open_parts = [], False, [], b""
        for a, b in zip(cuts, cuts[1:]):
            part = content[a:b]
            for kind, _, _, text, _ in lj.parts_of(part, within, stack, "result"):
                if kind == "item":
                    items.append(text)
                elif kind in ("head", "middle"):
                    open_parts += text
                elif kind == "tail":
                    items.append(open_parts + text)
                    open_parts = b""
            stack = lj.after(stack, *lj.summarize(part, within))
            within = (within + lj.quotes(part)) % 2 == 1
        assert stack == [] and not within
        whole = [t for k, _, _, t, _ in lj.parts_of(content, False, [], "result") if k == "item"]
        assert items == whole and all(t in (b'[]', b'0') or isinstance(json.loads(t), dict) for t in items)


def test_no_documents_and_broken_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"title": "x", "result": [{"name": "a"}, {"name": "b"')
    (tmp_path / "b.json").write_text("not json")
    (tmp_path / "c.json").write_text("[]")
    # Of a document that breaks off the items before that are read.
    assert sorted(r.entity for r in lj.scan_large_documents(spark, str(tmp_path), split_bytes=8).collect()) == ["a", "b"]
