"""Cost-balanced packing, product codes with split-point trees, conversation repair: against brute force and SQL."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslens.llm import balance, gnat, packing, queries, repair
from opslens.llm.tokens import VOCABULARY, encoder
from tools.check_sql import compare, connect


@pytest.mark.parametrize("name", ["op12_gnat_codes", "op13_glr_repair"])
def test_equals_sql(spark, sf_dir, name):
    diff, rows = compare(spark, connect(sf_dir), name, queries.queries()[name], queries.oracle_sql()[name], sf_dir)
    assert diff is None and rows > 0


# --- 11


def check_sequences(rows, length):
    """Every sequence gapless; lengths full or powers of two; returns the tokens."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end and n > 0
            end += n
        assert end == length or end < length and end & (end - 1) == 0
    return by


def test_balance_covers_every_id_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op11_cost_balanced(spark, sf_dir).collect()
    check_sequences(rows, 1024)
    enc, by = encoder(VOCABULARY), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for d in docs.select("doc_id", "text").collect():
        ids = np.frombuffer(enc.ids([d.text or ""])[0], np.uint32).tolist() + [0]
        end = 0
        for r in sorted(by.pop(d.doc_id), key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(ids)
            end += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:end], "<u4").tobytes())
        assert end == len(ids)
    assert not by


def slow_assign(sizes, length, cost):
    """The rule, read literally: the largest piece goes to the cheapest sequence with room for it, or what fits of it
    to the cheapest one with any room."""
    whole, rest = divmod(sum(sizes), length)
    caps = [length] * whole + [1 << b for b in range(20, -1, -1) if rest >> b & 1]
    room, costs, waiting, out = list(caps), [0] * len(caps), [(-n, i, 0) for i, n in enumerate(sizes) if n], []
    while waiting:
        waiting.sort()
        n, item, start = waiting.pop(0)
        fits = [s for s in range(len(caps)) if room[s] >= -n]
        at = min(fits or [s for s in range(len(caps)) if room[s]], key=lambda s: (costs[s], s))
        take = min(-n, room[at])
        if take < -n:
            waiting.append((n + take, item, start + take))
        out.append((item, start, take, at, caps[at] - room[at]))
        costs[at] += cost(take)
        room[at] -= take
    return out, costs


@pytest.mark.parametrize("seed", range(20))
def test_assign_is_the_rule(seed):
    rnd = random.Random(seed)
    length = rnd.choice([8, 64, 1024])
    sizes = [rnd.randint(0, length) for _ in range(rnd.randint(0, 120))]
    cost = balance.Cost(rnd.choice([1, 64, 1024]))
    assert balance.assign(sizes, length, cost) == slow_assign(sizes, length, cost)


def test_balance_evens_costs():
    rnd = random.Random(1)
    sizes = [min(512, 1 + int(rnd.expovariate(1 / 200))) for _ in range(5000)]
    pieces, costs = balance.assign(sizes, 1024)
    full = np.array(costs[: sum(sizes) // 1024])
    ordered = sorted(sizes, reverse=True)
    bins, _, fill = packing.best_fit(ordered, 1024)
    other = np.zeros(len(fill))
    np.add.at(other, bins, [balance.Cost()(n) for n in ordered])
    assert full.std() < 0.2 * other[np.array(fill) == 1024].std()
    assert len(pieces) - len(sizes) < 0.1 * len(sizes)  # cut


def test_balance_of_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(["", None, " ", "x" * 5000, "the of and to " * 5000, "a b"])] + [(None, "null id"), (5, "a b"), (5, "a b")]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, length int, sequence_id string")
    out = balance.pack(docs.coalesce(1), window=2000).collect()
    check_sequences(out, 1024)
    enc = encoder(VOCABULARY)
    want = sorted(len(enc.ids([t or ""])[0]) // 4 + 1 for _, t in rows)
    assert sum(r.length for r in out) == sum(want)
    assert sorted({(r.doc_id is None, r.doc_id, r.doc_tokens) for r in out}) == sorted({
        (i is None, i, len(enc.ids([t or ""])[0]) // 4 + 1) for i, t in rows})
    assert balance.pack(docs.limit(0)).collect() == []
    assert sorted(map(tuple, balance.pack(docs.coalesce(1), window=2000).collect()), key=str) == sorted(map(tuple, out), key=str)


def test_best_fit_hands_on_every_open_bin(spark, monkeypatch):
    """Bins that are half full in every task find each other in later rounds, however many there are."""
    monkeypatch.setattr(packing, "TASK_ITEMS", 100)
    alone = spark.range(3000).select(F.col("id").alias("uid"), F.lit(60).cast("long").alias("length"))
    got = packing.places(alone, 100, slack=2)
    assert got.select("sequence_id").distinct().count() == 3000
    # What fits them comes late in the order of ids, and is rare: later rounds must still meet it.
    some = alone.unionByName(spark.range(3000, 3400).select(F.col("id").alias("uid"), F.lit(39).cast("long").alias("length")))
    got = packing.places(some, 100, slack=2)
    assert got.count() == 3400 and got.select("sequence_id").distinct().count() <= 3005


# --- 12


@pytest.mark.parametrize("width,spread,entries", [(4, 40, 64), (4, 2, 64), (1, 5, 64), (8, 100, 64), (2, 3, 1), (2, 3, 7), (3, 0, 64), (4, 1 << 25, 64)])
def test_gnat_finds_what_a_full_search_finds(width, spread, entries):
    rng = np.random.default_rng(width * 1000 + spread % 97)
    book = rng.integers(-spread, spread + 1, (entries, width))
    q = np.concatenate([rng.integers(-spread, spread + 1, (500, width)), book, np.repeat(book[:1], 50, axis=0)])
    search = gnat.Search(book, gnat.grow(book))
    at, far = search(q)
    want = ((q[:, None] - book[None]) ** 2).sum(axis=2)
    assert (at == want.argmin(axis=1)).all() and (far == want.min(axis=1)).all()


def test_gnat_leaves_entries_out():
    rng = np.random.default_rng(3)
    book, q = rng.integers(-50, 50, (64, 4)), rng.integers(-50, 50, (2000, 4))
    search = gnat.Search(book, gnat.grow(book))
    search(q)
    assert search.compared < 0.5 * len(q) * len(book)


def test_tree_holds_every_entry_once_with_true_ranges():
    book = np.random.default_rng(4).integers(-3, 4, (64, 4))

    def below(node):
        out = [[int(p), *(below(c) if c else [])] for p, c in zip(node.points, node.children)]
        for i, p in enumerate(node.points):
            for j, members in enumerate(out):
                d = np.sqrt(((book[members] - book[p]) ** 2).sum(axis=1))
                assert node.low[i, j] <= d.min() and d.max() <= node.high[i, j]
        return [x for m in out for x in m]

    assert sorted(below(gnat.grow(book))) == list(range(64))


def slow_codes(rows):
    """rows (vec_id, label, vector) by plain Python integers."""
    import math

    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // 16 if kept else 0
    parts = [[r[2][p * w:(p + 1) * w] for r in kept] for p in range(16)]
    books = [[list(x) for x in xs[:64]] for xs in parts]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(2):
        for p, xs in enumerate(parts):
            groups = defaultdict(list)
            for x in xs:
                groups[near(x, books[p])[1]].append(x)
            for e, g in groups.items():
                books[p][e] = [sum(c) // len(g) for c in zip(*g)]
    out, total = [], defaultdict(int)
    for n, (i, lab, _) in enumerate(kept):
        found = [near(parts[p][n], books[p]) for p in range(16)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
        total[lab] += out[-1][3]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, err, total[lab]) for i, lab, code, err in out), key=str), digest


@pytest.mark.parametrize("n", [0, 1, 40, 300])
def test_codes_of_odd_vectors(spark, n):
    rnd = random.Random(n)
    rows = [(i, rnd.choice([None, 1, 2]), [rnd.gauss(0, 0.2) for _ in range(32)]) for i in range(n)]
    if n > 1:
        rows += [(7, 1, rows[3][2])] * 5 + [(None, None, rows[1][2]), (None, 1, rows[2][2])]
    rows += [(90, 1, None), (91, 1, [float("nan")] * 32), (92, None, [float("inf")] + [0.0] * 31), (93, 1, [None] + [0.0] * 31), (None, None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, code string, v int")
    coded, books = gnat.compress(frame.repartition(3))
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()), key=str)
    want, digest = slow_codes(rows)
    assert got == want
    if n:
        assert books.digest() == digest


def test_vectors_that_cannot_be_cut(spark):
    frame = spark.createDataFrame([(1, 1, [0.0] * 20)], "vec_id long, label int, embedding array<float>")
    with pytest.raises(ValueError, match="16 equal parts"):
        gnat.compress(frame)


# --- 13


def cheapest(symbols):
    """(cost, audit, roles) by trying all edits, two inserts in a row at most."""
    best = (2 * len(symbols), "D" * len(symbols), "")

    def go(i, out, cost, audit, inserts):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(symbols) and re.fullmatch(r"(s?(ua)+)?", out):
            best = min(best, (cost, audit, out))
        if inserts < 2:
            for r in "ua":
                go(i, out + r, cost + 5, audit + "I", inserts + 1)
        if i < len(symbols):
            c = symbols[i]
            go(i + 1, out, cost + 2, audit + "D", 0)
            if c != "-":
                cost += 5 if c.isupper() else 0
                go(i + 1, out + c.lower(), cost, audit + "K", 0)
                for r in "ua":
                    go(i + 1, out + r, cost + 1, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def test_repair_is_the_cheapest_of_all_edits():
    fix, rnd = repair.Repair(), random.Random(0)
    some = ["".join(s) for n in range(4) for s in itertools.product("suaUSA?-", repeat=n)]
    some += ["".join(rnd.choice("suauauaUA?-") for _ in range(6)) for _ in range(100)]
    for s in some:
        cost, audit, roles = fix.whole(s)
        assert (cost, audit, roles.replace("-", "")) == cheapest(s)


@pytest.mark.parametrize("cut", [1, 3, 50, 4000])
def test_blocks_chain_to_the_repair_of_the_whole(cut):
    fix, rnd = repair.Repair(), random.Random(cut)
    for n in (1, 2, 30, 3000):
        s = "".join(rnd.choice("suauauauauUA?-") for _ in range(n))
        blocks = [s[i:i + cut] for i in range(0, n, cut)]
        cost, path = fix.chain([fix.moves(b) for b in blocks])
        pieces = [fix.between(b, x, y) for b, (x, y) in zip(blocks, path)]
        end = fix.finish(((path[-1][1], 0),))
        assert (cost, "".join(e for e, _ in pieces) + end[2], "".join(r for _, r in pieces) + end[3]) == fix.whole(s)


def test_other_grammars():
    nested = (("s", ("b",)), ("b", ()), ("b", ("x", "b", "y")))
    with pytest.raises(ValueError, match="without bound"):
        repair.Repair(nested, given=("x",))
    # Any number of questions, each answered twice.
    twice = (("c", ()), ("c", ("c", "t")), ("t", ("u", "a", "a")))
    fix = repair.Repair(twice)
    assert fix.whole("uaauaa") == (0, "KKKKKK", "uaauaa")
    assert fix.whole("uuaa") == (2, "DKKK", "-uaa")
    assert fix.whole("uaua") == (2, "KKDK", "ua-a")


def slow_repair(rows):
    """The contract on a list of (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        by[c]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, seq in by.items():
        seq.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = {r[0] for r in seq if r[0] is not None}
        seen, symbols, faults = set(), "", []
        for _, role, text in seq:
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "b" if not last else "d" if (role, text) in seen else "t" if last[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            mark = role[:1] if role[:1] in tuple("sua") else "?"
            symbols += "-" if fault in ("b", "d") else mark.upper() if fault else mark
        initials = [r[1][:1] for r in seq]
        cost, audit, _ = cheapest(symbols)
        lines, row, at = [], 0, "0"
        roles = iter(cheapest(symbols)[2])
        for e in audit:
            if e != "D":
                r = repair.ROLES[next(roles)]
            if e == "I":
                lines.append(f"{r}:")
                continue
            if e != "D":
                lines.append(f"{seq[row][1] if e == 'K' else r}:{seq[row][2]}")
            row += 1
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations():
    rnd, rows = random.Random(2), []
    for c in [None, *range(60)]:
        for t in range(rnd.randint(1, 5)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rnd.choice(["A sentence.", "Another one!", "no end", "", " \n", None, "Really? ", "x. y"])
            rows.append((c, rnd.choice([t, t, t, t + 3, None]), role, text))
    return rows + [(5, 1, "user", "A sentence.")] * 3 + [(77, None, None, None)]


@pytest.mark.parametrize("parts,block", [("1", 16_384), ("8", 16_384), ("3", 2)])
def test_repair_of_odd_conversations(spark, monkeypatch, parts, block):
    rows = odd_conversations()
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, block int")
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted((tuple(r) for r in repair.repair_damaged(frame).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == slow_repair(rows)


def test_a_long_conversation_over_many_blocks(spark):
    rnd = random.Random(6)
    rows = [(1, t, rnd.choice(["user", "assistant"]), rnd.choice(["Fine.", f"Number {t}.", "cut"])) for t in range(40_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    (got,) = repair.repair_damaged(frame).collect()
    seq = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"1:{t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            seq += [("user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    seen, symbols = set(), ""
    for role, text in seq:
        symbols += "-" if not text or (role, text) in seen else role[0] if text[-1] in ".!?" else role[0].upper()
        seen.add((role, text))
    cost, audit, roles = repair.Repair().whole(symbols)
    assert (got.cost, got.audit) == (cost, audit)
    lines, row = [], 0
    for e, r in zip(audit, roles):
        if e == "I":
            lines.append(f"{repair.ROLES[r]}:")
            continue
        if e != "D":
            lines.append(f"{repair.ROLES[r]}:{seq[row][1]}")
        row += 1
    assert got.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_damaged(empty).collect() == []
