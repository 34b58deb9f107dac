"""Conversation repair against trying all edits, and against a plain pass over
the rows of each conversation."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from linecraft.llm import conversations as cv

from .fixtures_llm import CLASH, empty, same

SPACE = " \t\n\x0b\x0c\r"


def all_edits(letters, most_inserts=4):
    """Least (cost, audit) by trying every list of edits with few inserts."""
    found = []
    for n in range(most_inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(letters) + 1), n):
            for edits in itertools.product("KRD", repeat=len(letters)):
                roles, audit, cost = [], "", 0
                for i in range(len(letters) + 1):
                    k = places.count(i)
                    audit, cost, roles = audit + "I" * k, cost + 2 * k, roles + ["?"] * k
                    if i == len(letters):
                        break
                    x, e = letters[i], edits[i]
                    if x == "D" and e != "D":
                        break
                    audit += e
                    cost += {"K": 0, "R": 2, "D": 3}[e] + (e != "D" and x.isupper())
                    roles += {"K": [x.lower()], "R": ["?"], "D": []}[e]
                else:
                    continue
                if i < len(letters):
                    continue
                for lead in (0, 1):
                    body = roles[lead:]
                    if lead and roles[:1] != ["s"]:
                        continue
                    if (len(body) % 2 or (lead and not body)) or any(r not in ("?", "ua"[j % 2]) for j, r in enumerate(body)):
                        continue
                    found.append((cost, audit))
    return min(found)


def test_cells_equal_trying_all_edits():
    r = random.Random(5)
    cases = ["", *("".join(p) for n in (1, 2) for p in itertools.product("suaxUD", repeat=n))]
    cases += ["".join(r.choice("suaxSUAXD") for _ in range(r.choice((3, 4)))) for _ in range(40)]
    for letters in cases:
        got = cv.best(cv.parse(letters)) if letters else (0, "")
        assert got == all_edits(letters), letters


def one_pass(letters):
    ways = {p: cv._inserts().get((0, p)) for p in range(4)}
    for x in letters:
        new = {}
        for p, have in ways.items():
            for (a, q), w in cv._row_ways(x).items():
                if have and a == p:
                    new[q] = min(new.get(q, (10**9, "")), (have[0] + w[0], have[1] + w[1]))
        ways = {q: min((new[p][0] + c, new[p][1] + i) for (p, z), (c, i) in cv._inserts().items() if z == q and p in new) for q in range(4) if any(z == q and p in new for p, z in cv._inserts())}
    return min(ways[q] for q in (0, 3) if q in ways)


def test_any_cut_gives_the_same_cell():
    r = random.Random(6)
    for n in (5, 17, 60, 400):
        letters = "".join(r.choice("suaxSUAXD") for _ in range(n))
        whole = cv.parse(letters)
        assert cv.best(whole) == one_pass(letters)
        for _ in range(5):
            k = r.randrange(1, n)
            assert cv.combined(cv.parse(letters[:k]), cv.parse(letters[k:])) == whole
        # every interval cut anywhere: the full chart
        if n <= 17:
            chart = {(i, i + 1): cv.parse(letters[i]) for i in range(n)}
            for size in range(2, n + 1):
                for i in range(n - size + 1):
                    cells = {cv.combined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)}
                    assert len(cells) == 1
                    chart[i, i + size] = cells.pop()
            assert chart[0, n] == whole


def plain(rows):
    """The contract, row by row."""
    named = lambda v: " " if v is None else str(v)
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        fate = zlib.crc32(f"{named(conv)}:{named(turn)}".encode()) % 20
        role, text = named(role), named(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        own += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, own in convs.items():
        def key(x):
            size = str(len(x[1].encode()))
            return (x[0] is not None, x[0] or 0, hashlib.sha256((size + ":" + x[1] + x[2]).encode()).digest())

        own.sort(key=key)
        n = {"blank": 0, "duplicate": 0, "truncated": 0}
        letters, seen = "", set()
        for _, role, text in own:
            body, x = text.strip(SPACE), role[:1] if role[:1] in ("s", "u", "a") else "x"
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            letters += "D" if fault in ("blank", "duplicate") else x.upper() if fault else x
        firsts = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = one_pass(letters) if letters else (0, "")
        left, result, lead = list(own), [], (len(audit) - audit.count("D")) % 2
        for e in audit:
            want = ("user", "assistant")[(len(result) - lead) % 2]
            if e == "I":
                result.append((want, ""))
                continue
            _, role, text = left.pop(0)
            if e != "D":
                result.append((role if e == "K" else want, text))
        assert not left
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in result))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in result).encode()).hexdigest()
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha))
    return out


def table(spark, rows, parts=5):
    kinds = ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for k, v in CLASH.items())
    full = [(*r, *CLASH.values()) for r in rows]
    return spark.createDataFrame(full, f"conv_id bigint, turn bigint, role string, text string, {kinds}").repartition(parts)


def some_rows():
    r = random.Random(11)
    rows = []
    for conv in range(150):
        role = r.choice(("user", "system", "assistant"))
        for turn in range(r.randrange(9)):
            text = r.choice(("Yes.", "No!", "so what", "", " \n", "Why?\n", "\u00a0", "x" * 3000 + ".", "same text."))
            own = r.choice((role, role, "user", "assistant", "system", "tool", "", None, "upper"))
            rows.append((conv, turn if r.random() < 0.9 else None, own, text if r.random() < 0.9 else None))
            role = "assistant" if role == "user" else "user"
    rows += [(None, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(30)]
    rows += [(None, None, "user", "twice."), (None, None, "user", "twice."), (7, 3, "user", "tie a."), (7, 3, "user", "tie b.")]
    rows += [(1000, 2**62, "user", "far."), (1000, -(2**62), "user", "far.")]
    # one conversation with most rows, and equal rows in it
    rows += [(5000, t, ("user", "assistant")[r.random() < 0.5], r.choice(("Fine.", f"text {t}", f"text {t}!"))) for t in range(900)]
    rows += [(5001, 1, "user", "again.")] * 300
    return rows


def test_equal_to_a_plain_pass(spark):
    rows = some_rows()
    got = cv.digest(table(spark, rows))
    assert got.dtypes[1:7] == [(c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    same(got.collect(), plain(rows))


def test_conversations_are_cut(spark):
    rows = some_rows()
    plan = cv.scripts(cv.damage(table(spark, rows))).collect()
    parts = {r["conv_id"]: r["parts"] for r in plan}
    assert parts[5000] > 1
    assert max(r["part"] for r in plan if r["conv_id"] == 5000) == parts[5000] - 1


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_pieces_of_cut_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(cv, "CHUNK", chunk)
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(400)]
    same(cv.digest(table(spark, rows)).collect(), plain(rows))


def test_repaired_rows_read_right(spark):
    rows = some_rows()
    found = {}
    for r in cv.repaired(table(spark, rows)).collect():
        found.setdefault(r["conv_id"], []).append(r)
    for own in found.values():
        own.sort(key=lambda r: r["position"])
        assert [r["position"] for r in own] == list(range(len(own)))
        assert re.fullmatch("s?(ua)+", "".join(r["role"][:1] for r in own))
        assert all(r["text"] == "" and r["turn"] is None for r in own if r["edit"] == "I")


def test_empty_and_dropped(spark):
    assert cv.digest(empty(spark, "conv_id bigint, turn bigint, role string, text string")).collect() == []
    gone = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = cv.digest(table(spark, [(*gone, "user", "x.")])).collect()
    same(got, [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())])
