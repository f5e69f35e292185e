import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from quayside.llm import queries, repair

SPACES = " \t\n\x0b\x0c\r"


def classes(rows):
    seen, found = set(), []
    for role, text in rows:
        found.append(repair.classified(role, text, (role, text) in seen))
        seen.add((role, text))
    return found


def brute(rows):
    """Least (cost, audit, repaired) over all edits of a few rows, with up to two insertions at a place: more never help."""
    best = None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    options = []
    for row in classes(rows):
        own = [("D", None, 3)]
        if not row.blank and not row.duplicate:
            own += [("K", row.role, row.truncated), ("R", "user", 2 + row.truncated), ("R", "assistant", 2 + row.truncated)]
        options.append(own)
    for edits in product(*options):
        for between in product(inserts, repeat=len(rows) + 1):
            cost = sum(e[2] for e in edits) + 2 * sum(map(len, between))
            if best is not None and cost > best[0]:
                continue
            audit, left = "I" * len(between[0]), [(repair.NAMES[x], "") for x in between[0]]
            for (edit, role, _), (_, text), more in zip(edits, rows, between[1:]):
                audit += edit + "I" * len(more)
                left += [(role, text)] * (edit != "D") + [(repair.NAMES[x], "") for x in more]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in left)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, left
    return best


def some_rows(rng, most):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ustad", " "]
    texts = ["Yes.", "no end", " ", "", "What?\n", "a", "Yes."]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(most + 1))]


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_and_least_of_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(40):
        rows = some_rows(rng, 3)
        (cost, audit), passed = repair.joined([repair.ways(classes(rows))])
        left = list(repair.edited(rows, 0, audit))
        assert (cost, audit, left) == brute(rows)


def test_pieces_join_to_the_whole():
    rng = random.Random(9)
    for _ in range(60):
        rows = some_rows(rng, 14)
        whole = repair.joined([repair.ways(classes(rows))])[0]
        marked, cut, parts = classes(rows), 0, []
        while cut < len(rows):
            size = rng.randrange(1, 5)
            parts.append(marked[cut : cut + size])
            cut += size
        by_way = [repair.ways(p, range(4)) for p in parts]
        weight, passed = repair.joined(by_way)
        assert weight == whole
        assert "".join(by_way[k][w][1] for k, w in enumerate(passed)) == whole[1]
        left = [r for p, k, w in zip(parts, by_way, passed) for r in repair.edited([(x.role, x.text) for x in p], w[0], k[w][1])]
        assert left == list(repair.edited(rows, 0, whole[1]))


def test_agenda_takes_the_lightest():
    rules = [
        repair.Deduction(("a", "b"), "c", lambda x, y: (x[0] + y[0], x[1] + y[1])),
        repair.Deduction(("a",), "c", lambda x: (x[0] + 9, x[1])),
        repair.Deduction(("c", "c"), "d", lambda x, y: (x[0] + y[0], x[1])),
        repair.Deduction(("e",), "d", lambda x: (0, "")),
    ]
    final = repair.lightest({"a": (1, "x"), "b": (2, "y")}, rules, ["d", "e"])
    assert final["c"][0] == (3, "xy") and final["d"][0] == (6, "xy") and "e" not in final


def damaged(given):
    """By conversation, the rows (turn, role, text) after damage, in order; written out from the contract."""
    out = defaultdict(list)
    for conv, turn, role, text in given:
        role, text = (" " if x is None else x for x in (role, text))
        rows = out[conv]
        named = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(named.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def contract(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    if not rows:
        return conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    found = classes([r[1:] for r in rows])
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # a plain dynamic programme over places and states
    best = {0: (0, "", ())}

    def inserted(states):
        for _ in range(4):
            for state, (cost, audit, left) in list(states.items()):
                for name in "ua":
                    if name in repair.STATES[state]:
                        new = (cost + 2, audit + "I", (*left, (repair.NAMES[name], "")))
                        to = repair.STATES[state][name]
                        if to not in states or new[:2] < states[to][:2]:
                            states[to] = new
        return states

    inserted(best)
    for row in found:
        after = {}
        for state, (cost, audit, left) in best.items():
            options = [(state, (cost + 3, audit + "D", left))]
            if not row.blank and not row.duplicate:
                for name, edit in [(row.role, "K"), ("user", "R"), ("assistant", "R")]:
                    to = repair.STATES[state].get(name[:1])
                    if to is not None:
                        options.append((to, (cost + (2 if edit == "R" else 0) + row.truncated, audit + edit, (*left, (name, row.text)))))
            for to, new in options:
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = inserted(after)
    cost, audit, left = min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
    return (conv, gaps, *(sum(getattr(f, c) for f in found) for c in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations():
    rng = random.Random(4)
    rows, texts = [], ["Yes.", "no end", " ", "", "What? Well. \n", "a", "b!", "Zoë…", None]
    for conv in [*range(60), None, 1000]:
        for turn in range(rng.randrange(9) if conv != 1000 else 2500):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.8 else rng.choice(["system", "tool", "", None, "user"])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]) if rng.random() < 0.95 else None, role, f"{rng.choice(texts)}{turn % 7}."))
            if rng.random() < 0.4:
                rows[-1] = (*rows[-1][:3], rng.choice(texts))
    # equal turns of a conversation would leave the order of different rows open
    return list({(r[0], r[1] if r[1] is not None else f"null {r[0]}"): r for r in rows}.values())


@pytest.mark.parametrize("piece_rows", [3, repair.PIECE_ROWS])
def test_query(spark, tmp_path, monkeypatch, piece_rows):
    monkeypatch.setattr(repair.pieces, "__defaults__", (*repair.pieces.__defaults__[:4], piece_rows))
    given = conversations()
    frame = spark.createDataFrame([(*r, 1, "x") for r in given], "conv_id long, turn long, role string, text string, n int, piece string")
    frame.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op12_repair(spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r[c] for c in NAMES)) for r in got) == sorted(str(contract(c, rows)) for c, rows in damaged(given).items())


def test_repeats_of_one_row_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    same = spark.createDataFrame([(1, 2, "user", "Hello.")] * 700 + [(None, None, None, None)] * 700, schema)
    found = repair.pieces(same)
    decisions = repair.decided(found)
    facts = {r.conv: r for r in repair.facts(decisions).collect()}
    assert (facts["1"].duplicate, facts["1"].gaps, facts["1"].cost) == (699, 0, 699 * 3 + 2)
    assert facts["1"].audit == "K" + "D" * 699 + "I"
    assert (facts[None].blank, facts[None].audit) == (700, "D" * 700)
    left = [(r.conv, r.role, r.text) for r in repair.repaired(found, decisions).orderBy("part", "piece", "place").collect()]
    assert left == [("1", "user", "Hello."), ("1", "assistant", "")]
    none = repair.pieces(same.limit(0))
    assert repair.facts(repair.decided(none)).count() == 0
