"""Line dedup, filter audit and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from itertools import permutations, product

import numpy as np
import pyarrow as pa
import pytest

from txlens.llm import common, conversations, filteraudit, linededup

DOCS = "doc_id bigint, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\x0c\r"


# ---- lines ----------------------------------------------------------------------------------


def key_of(line):
    return line.strip(WHITE).translate({c: c + 32 for c in range(65, 91)})


def brute_lines(rows, min_chars, min_docs, keep=max):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key_of(line)
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            h = holders.get(key_of(line), ())
            known = [x for x in h if x is not None]
            if len(h) < min_docs or i == (keep(known) if known else None):
                stay.append(line)
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def random_docs(seed, n):
    r = random.Random(seed)
    pool = ["".join(r.choice("abAB é\tü") for _ in range(r.randint(0, 12))) for _ in range(25)] + ["", " \t ", "x" * 300]
    rows = []
    for i in range(n):
        lines = [r.choice(pool) if r.random() < 0.7 else f"own {i} {k} line" for k in range(r.randint(0, 8))]
        lines = [r.choice(["", " ", "\t"]) + (x.upper() if r.random() < 0.3 and x.isascii() else x) + r.choice(["", "\r"]) for x in lines]
        rows.append((None if i % 23 == 0 else i - i % 3 if i % 11 == 0 else i, None if i % 17 == 0 else "\n".join(lines)))
    return rows


def lines_of(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS).selectExpr("*", "1 AS digest", "2 AS drops", "3 AS segment").repartition(5)
    found = linededup.drop_repeated_lines(df, **more).collect()
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found), key=str)


@pytest.mark.parametrize("joined", [False, True])
@pytest.mark.parametrize("keep", ["last", "first"])
def test_lines_equal_brute_force(spark, monkeypatch, joined, keep):
    """Also in the form for more keys than the tasks are sent, with hot keys apart."""
    if joined:
        monkeypatch.setattr(linededup, "TABLE_KEYS", 3)
        monkeypatch.setattr(linededup, "HOT_DOCS", 20)
    monkeypatch.setattr(linededup, "FLUSH", 50)
    rows = random_docs(4, 150)
    assert lines_of(spark, rows, min_chars=4, min_docs=3, keep=keep) == brute_lines(rows, 4, 3, max if keep == "last" else min)


def test_full_filters_only_suspect_more(spark, monkeypatch):
    monkeypatch.setattr(linededup, "TWICE_BITS", 16 * 8)
    rows = random_docs(5, 120)
    assert lines_of(spark, rows, min_chars=4, min_docs=3) == brute_lines(rows, 4, 3)


def test_line_edge_cases(spark):
    line = "A line of at least forty code points, é and more"
    rows = [(i, f"{line}\n{i}") for i in range(4)]
    assert all(r[3] == 0 for r in lines_of(spark, rows))  # four documents are not enough
    assert all(r[3] == 0 for r in lines_of(spark, rows + [(3, line)]))  # nor a fifth row of a known id
    found = lines_of(spark, rows + [(9, f"{line}\n {line.upper().replace('É', 'é')}\n"), (None, line), (7, None), (8, "")])
    assert (9, f"{line}\n {line.upper().replace('É', 'é')}\n", 3, 0) in found  # repeats in the keeping document stay
    assert (None, "", 1, 1) in found and (7, "", 1, 0) in found and (8, "", 1, 0) in found and (0, "0", 2, 1) in found
    assert lines_of(spark, []) == []
    long = "z" * 39
    assert all(r[3] == 0 for r in lines_of(spark, [(i, f" {long} ") for i in range(9)]))
    big = "\n".join(f"line number {k} of a very long text, the same everywhere" for k in range(30_000))
    found = lines_of(spark, [(i, big) for i in range(6)])
    assert [(r[0], r[3]) for r in found] == [(i, 30_000 * (i < 5)) for i in range(6)] and found[0][1] == ""


def test_line_bounds_in_sliced_columns():
    texts = ["a\nb", None, "", "\n", "x\n\ny\n", "é\nü"]
    data, offsets = common.text_buffers(pa.array(["zz"] + texts).slice(1))
    starts, ends, firsts = linededup.line_bounds(data, offsets)
    raw = data.tobytes()
    found = [[raw[starts[k] : ends[k]].decode() for k in range(firsts[t], firsts[t + 1])] for t in range(len(texts))]
    assert found == [(t or "").split("\n") for t in texts]


def test_merged_filters_hold_every_repeat():
    """No repeat is missed however the hashes are dealt to tasks, and few others are suspected."""
    r = np.random.default_rng(3)
    hashes = r.integers(0, 1 << 63, 60_000).astype(np.uint64)
    repeated = hashes[:3_000]
    filters = linededup.Filters(100_000)
    parts = {}
    for k, task in enumerate(np.array_split(hashes, 7)):
        for s, a, b in filters.marked(np.concatenate([task, repeated[k::7]])):
            parts.setdefault(s, []).append((a, b))
    twice = filters.gathered([(s, filters.merged(iter(p))) for s, p in parts.items()])
    assert filters.suspects(twice, repeated).all()
    assert filters.suspects(twice, hashes[3_000:]).mean() < 0.02


# ---- filter audit ---------------------------------------------------------------------------


def fails(text, first_id, i):
    words = WORD.findall(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 2 * len(text),
        any(c in "#$%&*|" for c in text), i is not None and first_id is not None and first_id < i,
    )


def brute_audit(rows, labels):
    first, good, toxic = {}, set(), set()
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        if q == 1:
            good.add(i)
        if x == 1:
            toxic.add(i)
    good.discard(None), toxic.discard(None)
    parts = {}
    for i, t, s in rows:
        parts.setdefault(s or "", []).append((fails(t or "", first.get(t or ""), i), i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                gone, left = [d for d in left if d[0][k]], [d for d in left if not d[0][k]]
                shapley[letter] += len(gone)
                failing = sum(d[0][k] for d in docs)
                alone = sum(d[0][k] and sum(d[0]) == 1 for d in docs)
                found.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone), letter])
        out += [(*f[:-1], shapley[f[-1]]) for f in found]
    return sorted(out)


def audit_of(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS mask", "2 AS n", "3 AS part", "4 AS id").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 AS spread")
    return sorted(tuple(r) for r in filteraudit.filter_audit(docs, marks).collect())


def test_audit_equals_brute_force(spark):
    r = random.Random(6)
    long = " ".join(f"word{k}" for k in range(210))
    pool = ["", None, long, "a " * 250, "ABC " * 210, long + " #", long.upper(), "x", " \t\n", long + " tail", " " + "b c " * 120]
    rows = [(None if i % 19 == 0 else i - i % 2 if i % 7 == 0 else i, r.choice(pool), r.choice(["s1", "s1", "s2", None, ""])) for i in range(120)]
    labels = [(r.choice([None, *range(120)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(150)]
    assert audit_of(spark, rows, labels) == brute_audit(rows, labels)


def test_audit_edge_cases(spark):
    assert audit_of(spark, [], []) == []
    found = audit_of(spark, [(1, " ".join(f"w{k}" for k in range(200)), None)], [])
    assert len(found) == 600 and {f[3:] for f in found} == {(1, 0, 0, 0, 0, 0, 0)}
    same = [(5, "x", "s")] * 3 + [(None, "x", "s")] * 2 + [(9, "x", "t")]
    assert audit_of(spark, same, [(5, 1, 1), (5, 0, 0)]) == brute_audit(same, [(5, 1, 1)])


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5])
def test_intervals_name_the_removing_step(size):
    for mask in range(1 << size):
        spans = filteraudit.removal_intervals(mask, size)
        for rank, order in enumerate(permutations(range(size))):
            want = next((s for s, k in enumerate(order, 1) if mask >> k & 1), None)
            assert [s for s, found in spans.items() if any(a <= rank < b for a, b in found)] == ([want] if want else [])


# ---- conversations --------------------------------------------------------------------------


def brute_repair(initials, faults):
    """All states after each row with the least (cost, audit), insertions tried twice in a row."""
    step = {"start": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    states = {"start": (0, "")}

    def insert(states):
        for _ in range(3):
            for s, (c, a) in list(states.items()):
                for r, t in step[s].items():
                    if r in "ua":
                        states[t] = min(states.get(t, (1 << 30, "")), (c + 5, a + "I"))
        return states

    for x, f in zip(initials, faults):
        new = {}
        for s, (c, a) in insert(states).items():
            options = [(s, c + 2, "D")]
            if f not in (1, 2):
                more = 5 if f == 3 else 0
                options += [(step[s][x], c + more, "K")] if x in step[s] else []
                options += [(t, c + more + 1, "R") for r, t in step[s].items() if r in "ua"]
            for t, cost, letter in options:
                new[t] = min(new.get(t, (1 << 30, "")), (cost, a + letter))
        states = new
    insert(states)
    return min(v for s, v in states.items() if s in ("start", "a"))


def test_search_equals_brute_force_on_all_short_conversations():
    for n in range(5):
        for initials in product("suat", repeat=n):
            for faults in product((0, 1, 3), repeat=n) if n < 4 else [(0,) * n, (3,) * n, (0, 3) * (n // 2), (3, 0) * (n // 2), (0, 1, 0, 0)]:
                assert conversations.repair(list(initials), list(faults)) == brute_repair(initials, faults)


def test_search_equals_brute_force_on_long_conversations():
    r = random.Random(8)
    for n in [7, 20, 60, 400]:
        for mix in ("ua", "suat", "s", "aaau", "uuuuua"):
            initials = [r.choice(mix) if r.random() < 0.3 else "ua"[i % 2] for i in range(n)]
            faults = [r.choice((0, 0, 0, 0, 1, 2, 3)) for _ in range(n)]
            assert conversations.repair(initials, faults) == brute_repair(initials, faults)


def brute_report(rows, damage=True):
    out, groups = [], {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20 if damage else 99
        kept = groups.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in found:
            t = text.rstrip(WHITE)
            faults.append(1 if not t else 2 if (role, text) in seen else 3 if t[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [t for t, _, _ in found if t is not None]
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(initials, initials[1:]))
        cost, audit = brute_repair(initials, faults)
        lines, i = [], 0
        state = "start"
        for letter in audit:
            due = "assistant" if state == "u" else "user"
            if letter != "I":
                _, role, text = found[i]
                i += 1
            if letter == "D":
                continue
            own = (role, text) if letter == "K" else (due, text if letter == "R" else "")
            lines.append(":".join(own))
            state = own[0][0]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, digest))
    return sorted(out, key=str)


CONV = "conv_id bigint, turn bigint, role string, text string"


def report_of(spark, rows, damage=True):
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS kind", "2 AS place", "3 AS audit", "4 AS head").repartition(3)
    return sorted((tuple(r) for r in conversations.repair_report(df, damage).collect()), key=str)


@pytest.mark.parametrize("damage", [True, False])
def test_report_equals_brute_force(spark, damage):
    r = random.Random(9)
    rows = []
    for c in [None, *range(150)]:
        for t in range(r.choice([1, 2, 3, 6, 9])):
            role = r.choice(["user", "assistant", "system", None, "", "tool"]) if r.random() < 0.2 else ("user", "assistant")[t % 2]
            text = r.choice([None, "", " \t", "Yes.", "No", "No", "Why?\n", "x" * 80 + "."]) if r.random() < 0.4 else f"Text {c} {t}."
            rows.append((c, None if r.random() < 0.05 else t - (r.random() < 0.1), role, text))
    rows += rows[:20]
    assert report_of(spark, rows, damage) == brute_report(rows, damage)


def test_report_edge_cases(spark):
    assert report_of(spark, []) == []
    nothing = hashlib.sha256(b"").hexdigest()
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert report_of(spark, [(dropped, 0, "user", "Hi.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]
    far = [(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "Ho.")]
    assert report_of(spark, far, False)[0][5:8] == (0, 0, "KK")
    assert report_of(spark, [(1, 0, "assistant", "Hi.")], False)[0][6:] == (2, "D", nothing)
    long = [(7, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(5_000) if t % 50]
    assert report_of(spark, long, False) == brute_report(long, False)


def test_repaired_turns_hold_the_texts(spark):
    rows = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Ho."), (1, 3, "user", "")], CONV)
    rows = conversations.prepared(rows)
    solved = conversations.solve(rows)
    found = [tuple(r) for r in conversations.repaired_turns(rows, solved).collect()]
    assert found == [(1, 1, "system", "Be kind.", "K"), (1, 2, "user", "Hi.", "R"), (1, 3, "assistant", "Ho.", "K")]
