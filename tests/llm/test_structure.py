"""Conversations, manifests and lines against brute force, and on odd inputs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from featurelake.functions import ranges, skew
from featurelake.llm import lines, merkle, turns

BLANKS = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- conversations


def cheapest(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) by comparing (cost, letters) from the end, two inserts per gap allowed."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(BLANKS)
        faults.append("blank" if not body else "twice" if (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = [None] * (len(rows) + 1)

    def ways(i, state, inserted):
        out = []
        if inserted < 2:
            for x in "ua":
                if x in follows[state] and (rest := ways(i, x, inserted + 1)):
                    out.append((rest[0] + 2, "I" + rest[1], [names[x] + ":", *rest[2]]))
        if i == len(rows):
            return min([*out, *([(0, "", [])] if state in ("", "a") else [])], default=None)
        _, role, text = rows[i]

        def then(x, cost, letter, line):
            if rest := best[i + 1].get(x):
                out.append((rest[0] + cost, letter + rest[1], [*line, *rest[2]]))

        then(state, 3, "D", [])
        if faults[i] not in ("blank", "twice"):
            extra = faults[i] == "cut"
            if role and role[0] in follows[state]:
                then(role[0], extra, "K", [f"{role}:{text}"])
            for x in "ua":
                if x in follows[state]:
                    then(x, 2 + extra, "R", [f"{names[x]}:{text}"])
        return min(out, default=None)

    for i in range(len(rows), -1, -1):
        best[i] = {state: found for state in ("", "s", "u", "a") if (found := ways(i, state, 0))}
    at = [t for t, _, _ in rows if t is not None]
    gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, text = best[0][""]
    return gaps, faults.count("blank"), faults.count("twice"), faults.count("cut"), illegal, cost, audit, sha("\n".join(text))


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(0, 9)):
            role = rng.choice(["system", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut", " \t", "", "Why? \n", None, "x" * 30, "é?"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    for k in range(700):
        rows.append((1000, k, rng.choice(["user", "user", "assistant", "system"]), rng.choice([f"{k}.", f"{k}", "again."])))
    rows += [(None, 1, "user", "a."), (None, 2, "user", "a."), (2000, None, "system", "s."), (2001, 5, "system", "z" * 1_000_000)]
    rows += [(2002, 1, "user", "same.")] * 40
    return rows


@pytest.mark.parametrize("forced", [False, True])
def test_conversations(spark, monkeypatch, forced):
    rows = conversations()
    if forced:  # leaves of four rows, several partitions to a conversation
        monkeypatch.setattr(turns, "LEAF_BITS", 2)
        monkeypatch.setattr(turns, "laid_out", lambda df, by: ranges.laid_out(df, by, partitions=7))
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, code int")
    done = turns.repair(frame.repartition(5))
    found = turns.on_keys(done.report.drop("end"), done.audit(), ["conv"])
    found = turns.on_keys(found, turns.digests(done.repaired()), ["conv"], "left")
    got = {r[0]: tuple(r)[1:-1] + (r[-1] or sha(""),) for r in found.collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert set(got) == set(by)

    def order(r):
        return r[0] is not None, r[0] or 0, r[1]

    for conv, some in by.items():
        some.sort(key=order)
        if len({order(r) for r in some}) < len(set(some)):  # several texts of one turn and role come by hash
            hashed = spark.createDataFrame([(r[2],) for r in set(some)], "text string").select("text", F.xxhash64("text").alias("h")).collect()
            places = {r.text: r.h for r in hashed}
            some.sort(key=lambda r: (*order(r), places[r[2]]))
        assert got[conv] == cheapest(some), conv


def test_repaired_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "user", "a."), (2, 0, "system", "s.")], "conv_id long, turn long, role string, text string")
    done = turns.repair(frame)
    assert sorted(tuple(r) for r in done.repaired().collect()) == [(1, 0, 0, "user", "a."), (1, 1, 1, "assistant", "b")]
    assert sorted((r.conv, r.audit) for r in done.audit().collect()) == [(1, "KRD"), (2, "D")]
    none = turns.repair(frame.filter("1 = 0"))
    assert none.report.count() == none.audit().count() == none.repaired().count() == turns.digests(none.repaired()).count() == 0


# --- manifests


def levels_of(hashes, fanout):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def steps_of(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        run = range(i // fanout * fanout, min(len(level), (i // fanout + 1) * fanout))
        out.append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        i //= fanout
    return out


@pytest.mark.parametrize(("fanout", "block"), [(2, 1024), (2, 4), (3, 10)])
def test_manifest(spark, fanout, block):
    rng = random.Random(12)
    rows = [(rng.choice([i, i, None]), rng.choice(["en", "en", "en", "fr", "é", None]), f"t{rng.randint(0, 50)}" * rng.randint(0, 3)) for i in range(180)]
    rows += [(500, "en", "same")] * 5 + [(3, "solo", None)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, lang string, text string, hash int").repartition(4)
    frame = frame.withColumn("leaf", merkle.leaf_hash(["doc_id", "lang", "text"]))
    got = merkle.manifest(frame, "lang", "doc_id", fanout=fanout, block=block)
    got = got.withColumns({"folded": merkle.fold("leaf", "chain"), "wrong": merkle.fold(F.unhex(F.sha2("leaf", 256)), "chain"), "proof": merkle.proof("chain")}).collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha("".join(map(field, r)))))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {n: levels_of([h for *_, h in sorted(groups[n])], fanout) for n in names}
    top = levels_of([trees[n][-1][0] for n in names], fanout)
    expected = []
    for g, n in enumerate(names):
        for i, leaf in enumerate(trees[n][0]):
            chain = steps_of(trees[n], i, fanout) + steps_of(top, g, fanout)
            expected.append((n, i, leaf, trees[n][-1][0], top[-1][0], chain))
    found = [(r.lang, r.lo, r.leaf.hex(), r.subroot.hex(), r.root.hex(), [(s.left.hex(), s.right.hex()) for s in r.chain]) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert all(r.folded == r.root != r.wrong and r.hi == r.lo + 1 and r.hash == 7 for r in got)
    assert all(r.proof == b"".join(a + b for a, b in (tuple(s) for s in r.chain)) for r in got)


def test_manifest_of_nothing_and_one(spark):
    frame = spark.createDataFrame([(1, "en", b"a" * 32)], "doc_id long, lang string, leaf binary")
    one = merkle.manifest(frame, "lang", "doc_id").first()
    assert one.leaf == one.subroot == one.root and one.chain == []
    assert merkle.manifest(frame.filter("1 = 0"), "lang", "doc_id").count() == 0


# --- lines


@pytest.mark.parametrize(("documents", "hot"), [(2, 2_000_000), (3, 2_000_000), (3, 4), (5, 4)])
def test_lines(spark, monkeypatch, documents, hot):
    monkeypatch.setattr(lines, "hot_of", lambda counts, keys, n: skew.hot_of(counts, keys, n, hot))
    rng = random.Random(13)
    pool = ["  A line that is Shared\t", "a line that is shared", "short", "", " ", "\x0bÉ line of twenty points", "another line which is long enough", "x" * 19, "y" * 20]
    rows = [(i, "\n".join(rng.choice([*pool, f"a line of its own, number {i}"]) for _ in range(rng.randint(0, 7)))) for i in range(40)]
    rows += [(5, rows[5][1]), (5, rows[5][1] + "\n" + pool[0]), (None, pool[0] + "\n" + pool[6]), (None, pool[0]), (90, None), (91, ""), (92, "\n\n"), (93, "z" * 3_000_000 + "\r\n" + pool[8])]
    frame = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, h string, n_lines int").repartition(5)

    def key(line):
        return line.strip(BLANKS).translate({c: c + 32 for c in range(65, 91)})

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(-1 if i is None else i)
    expected = []
    for i, text in rows:
        every = (text or "").split("\n")
        mine = -1 if i is None else i
        kept = [x for x in every if len(holders.get(key(x), ())) < documents or max(holders[key(x)]) == mine]
        expected.append((i, len(every), len(every) - len(kept), "\n".join(kept), "clash"))
    got = lines.dedupe_lines(frame, documents=documents).select("doc_id", "n_lines", "n_dropped", "text", "h").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert lines.dedupe_lines(frame.filter("1 = 0")).count() == 0
