"""Text operators against brute force, and on odd inputs: NULLs, empty and long texts, repeated rows, clashing columns."""

import hashlib
import random
import re

import pytest

from featurelake.llm import bwt, decontaminate, jaccard, pii, repeats, secrets, toxicity
from featurelake.llm.common import table

SYLLABLES = ["an", "er", "the", "in", "é", "ou", "sch", "ñ"]


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages, short and empty ones."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(1, 200))) for _ in range(60)]
    base = words(rng, 120)
    for _ in range(25):
        changed = list(base)
        for _ in range(rng.randint(0, 6)):
            changed[rng.randrange(len(changed))] = "neu" + rng.choice(SYLLABLES)
        texts.append(" ".join(changed))
    texts += [texts[0]] * 20 + [texts[3] + " tail", "Ab  CD\tef", "ab cd EF", "one", "", " \n ", "x" * 500, "ab" * 400]
    passage = " ".join(words(rng, 30))
    texts += [f"{' '.join(words(rng, 20))} {passage} {' '.join(words(rng, 20))}" for _ in range(15)]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark, corpus):
    rows = [(i, t, "clash", i) for i, t in corpus.items()] + [(7, corpus[7], "repeated", 0), (1000, None, None, None), (None, corpus[0], "no id", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, class string, n long").repartition(4)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("1 = 0")


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def test_jaccard_components(docs, nothing, corpus):
    sets = {i: shingle_set(t) for i, t in corpus.items()}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = jaccard.join(docs).collect()
    assert len(got) == len(corpus) + 3
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id in sets} == {(i, len(s), find(i)) for i, s in sets.items()}
    odd = {r.doc_id: r for r in got if r.doc_id not in sets}
    assert (odd[1000].n_shingles, odd[1000].component_id) == (0, 1000)
    assert odd[None].component_id == find(0)
    kept = jaccard.clean(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i in sets} | {1000})
    assert jaccard.join(nothing).count() == 0


def test_repeated_bytes(docs, nothing, corpus):
    data, least = {i: t.encode() for i, t in corpus.items()}, {}
    for i in sorted(data):
        for k in range(len(data[i]) - 49):
            least.setdefault(data[i][k : k + 50], i)
    got = {r.doc_id: r for r in repeats.remove(docs).collect()}
    assert len(got) == len(corpus) + 2
    for i, text in data.items():
        gone = bytearray(len(text))
        for k in range(len(text) - 49):
            if least[text[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(text), sum(gone), spans, kept), i
    assert sum(r.n_removed for r in got.values()) > 1000
    assert (got[1000].n_bytes, got[1000].kept) == (0, b"")
    assert got[None].n_removed == 0 and bytes(got[None].kept) == data[0]
    assert repeats.remove(nothing).count() == 0


def test_repeated_bytes_messages(spark, monkeypatch):
    """Some megabytes of a task's text are one batch, which sends a bucket one message."""
    from featurelake.llm import postings

    rng = random.Random(10)
    texts = [" ".join(words(rng, 10_000)) for _ in range(40)]
    texts += [t[len(t) // 2 :] + texts[i - 1][: len(t) // 2] for i, t in enumerate(texts[:10])]
    assert 2_500_000 < sum(len(t.encode()) for t in texts) < 5_000_000
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    known = postings.keyed(rows, "doc_id", "text")
    asked, sent = [], postings.sent
    monkeypatch.setattr(postings, "sent", lambda *a, **b: asked.append(sent(*a, **b)) or asked[-1])
    found = repeats.found(known.withColumnRenamed("doc_id", "doc_key"))
    assert asked[0].select("batch").distinct().count() == 1
    names = postings.shared_keys(known, repeats.distinct_names, repeats.shared_names, "doc_id long, text_hash long, names array<int>")
    both = known.join(names, ["doc_id", "text_hash"]).withColumnRenamed("doc_id", "doc_key").coalesce(1)
    assert repeats.pieces_sent(both, postings.LEAST_BUCKETS).count() <= postings.LEAST_BUCKETS + 1
    data = [t.encode() for t in texts]
    least = {}
    for i, t in enumerate(data):
        for k in range(len(t) - 49):
            least.setdefault(hash(t[k : k + 50]), i)
    lost = {}
    for i, t in enumerate(data):
        for k in range(len(t) - 49):
            if least[hash(t[k : k + 50])] < i:
                if i in lost and lost[i][-1][1] >= k:
                    lost[i][-1][1] = k + 50
                else:
                    lost.setdefault(i, []).append([k, k + 50])
    assert len(lost) >= 10
    assert {r.doc_key: list(map(list, zip(r.starts, r.ends, strict=True))) for r in found.collect()} == lost


def test_batches_spread():
    """What batches keep to themselves passes through many buckets, whatever the number of buckets."""
    from featurelake.llm import postings

    empty = [[]] * 6
    import numpy as np

    for buckets in (256, 1000, 1024):
        seen = [postings.batch_messages(*(np.array(x, np.uint64) for x in empty), made | task << 32, buckets)[0][0] for task in range(200) for made in range(4)]
        assert max(map(seen.count, seen)) <= 12 and max(seen) < buckets


def test_repeated_bytes_shares(monkeypatch):
    """A bucket's pieces in shares of a few bytes, against brute force and against one share."""
    import numpy as np

    rng = random.Random(11)
    seeds = [bytes(rng.choice(b"abc") for _ in range(50)) for _ in range(12)]
    strings, names, ids = [], [], []
    for _ in range(400):
        k = rng.randrange(12)
        strings.append(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 3))) + seeds[k] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 3))))
        names.append((k << 20) + k)  # of 24 bits
        ids.append(rng.randrange(100))
    args = np.array(ids), np.array([len(s) - 49 for s in strings], np.uint8), np.array(names, np.uint64), np.frombuffer(b"".join(strings), np.uint8)
    least = {}
    for i, name, s in zip(ids, names, strings, strict=True):
        for k in range(len(s) - 49):
            key = name, s[k : k + 50]
            least[key] = min(i, least.get(key, i))
    wanted = [least[name, s[k : k + 50]] < i for i, name, s in zip(ids, names, strings, strict=True) for k in range(len(s) - 49)]
    for size in (1 << 20, 5_000, 300):
        monkeypatch.setattr(repeats, "SHARE_BYTES", size)
        assert repeats.shares_later(*args).tolist() == wanted


@pytest.mark.parametrize("width", [1, 3, 6])
def test_common_windows_of_wide_words(width, monkeypatch):
    monkeypatch.setattr(bwt, "NARROW", 0)
    test_common_windows(width)


@pytest.mark.parametrize("width", [1, 3, 6])
def test_common_windows(width):
    import numpy as np

    rng = random.Random(width)
    for _ in range(30):
        strings = [bytes(rng.choice(b"abc") for _ in range(rng.randint(max(width, 2), 14))) for _ in range(rng.randint(1, 12))]
        lengths = np.array([len(s) for s in strings])
        data = np.frombuffer(b"".join(strings), np.uint8)
        string, place, group = bwt.common_windows(data, np.cumsum(lengths) - lengths, lengths, width)
        cut = {(s, p): strings[s][p : p + width] for s, p in zip(string.tolist(), place.tolist(), strict=True)}
        assert len(cut) == sum(len(s) - width + 1 for s in strings)
        names = {}
        for key, g in zip(cut, group.tolist(), strict=True):
            names.setdefault(cut[key], set()).add(g)
        assert all(len(g) == 1 for g in names.values())
        assert len(set.union(*names.values())) == len(names)


def test_secrets(spark, nothing):
    rng = random.Random(1)
    pieces = ["password", "TOKEN", "api_key", "apikey", "secret", "passwd", "=", ": ", '"', "'", " ", "AKIA", "ABCDEFGH1234", "deadbeef", "0123456789abcdef" * 2, "x", "é", "\u212a", "ſecret", "abc.def/+", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", None, "a" * 31, "a" * 32, "AKIA" + "B" * 11, "AKIA" + "B" * 12]
    good = "ghp_" + "z" * 30
    import zlib

    value, check = zlib.crc32(b"z" * 30), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        check = secrets.BASE62[rest] + check
    texts += [f"x {good}{check} y", f"x {good}{'0' * 6} y"]
    docs = spark.createDataFrame([(i if i else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    got = secrets.report(secrets.find_secrets(docs)).collect()
    assert len(got) == len(texts)
    by_id = {r.doc_id or 0: r for r in got}
    kinds = [(re.compile(secrets.ASSIGN, re.A | re.I), lambda m: len(m[2]) >= 8), (re.compile(secrets.ACCESS), lambda m: len(m[0]) >= 16), (re.compile(secrets.HEX), lambda m: len(m[0]) >= 32)]
    for i, t in enumerate(texts):
        spans = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in p.finditer(t or "") if ok(m))
        base = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert by_id[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), t
        assert [by_id[i].n_assign, by_id[i].n_access, by_id[i].n_hex] == [sum(x[1] == k for x in spans) for k in range(3)]
    assert by_id[len(texts) - 2].spans == "github:2:42" and by_id[len(texts) - 1].spans == ""
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    assert {r.spans: r.text for r in clean.collect()}[len(texts) - 2] == "x [github] y"
    assert secrets.find_secrets(nothing).count() == 0


def test_decontamination(spark, docs, nothing, corpus):
    rng = random.Random(9)
    long = " ".join(words(rng, 3000))
    item = " ".join(words(rng, 30))
    split = item.split()
    texts = {1: f"{long} {item} {long}", 2: item.upper() + ".", 3: " ".join(split[:25]), 4: " ".join(split[:8]), 5: f"x tiny item, y {long}", 6: "", 7: None}
    near = list(split)
    near[0] = near[-1] = "other"
    texts[8] = " ".join(near)
    found = spark.createDataFrame([(i, t, "a") for i, t in texts.items()] + [(2, item, "again"), (None, item, "b")], "doc_id long, text string, key string")
    items = spark.createDataFrame([(1, item), (2, "Tiny item"), (3, ""), (4, None), (None, "never there at all, not once")], "item_id long, text string")
    got = decontaminate.find(found, items).collect()
    expected = set()
    for i, t in [*texts.items(), (None, item)]:
        own = re.findall(r"[^\W_]+", (t or "").lower())
        for j, asked in ((1, item), (2, "tiny item")):
            asked = re.findall(r"[^\W_]+", asked.lower())
            w = min(5, len(asked))
            one, two = ({tuple(x[k : k + w]) for k in range(len(x) - w + 1)} for x in (asked, own))
            if len(one & two) >= 0.8 * len(one):
                expected.add((i, j, len(one), len(one & two)))
    assert {tuple(r) for r in got} == expected and {x[0] for x in expected} >= {1, 2, 5, None}
    assert len(got) == len(expected)
    assert sorted(r.doc_id or 0 for r in decontaminate.clean(found, items).collect()) == sorted(set(texts) - {x[0] for x in expected})
    assert decontaminate.find(docs, items.filter("1 = 0")).count() == 0 and decontaminate.find(nothing, items).count() == 0


def test_pii(spark, nothing):
    names = pii.Pseudonyms(b"key")
    text = "call +1 (017) 555-7713, ip 129.38.82.176, card 4111 1111 1111 1111, born 1999-12-31, a.b2@mail.example.com, DE89 3704 0044 0532 0130 00"
    new, spans = names.replaced(text)
    assert [k for k, _, _ in spans] == ["phone", "ipv4", "card", "date", "email", "iban"]
    assert all(text[s:e] not in new for _, s, e in spans)
    assert [k for k, _, _ in names.replaced(new)[1]] == [k for k, _, _ in spans]  # still valid, in the same format
    assert names.card("4111111111111111").replace(" ", "") == names.card("4111 1111 1111 1111").replace(" ", "")
    assert sorted(names.permute(i, 1000, "t") for i in range(1000)) == list(range(1000))
    assert pii.Pseudonyms(b"other").replaced(text)[0] != new
    for odd in ("999.1.1.1", "4111111111111112", "2001-02-30", "DE00 3704 0044 0532 0130 00", "12345", "",
                "de00 3704 0044 0532 0130 00", "in12 that have been 12", "00442079460958", "1.0044 20 7946", "0012 345 678", "0021 2345 678"):
        assert names.replaced(odd) == (odd, [])
    docs = spark.createDataFrame([(1, text, 5), (1, text, 6), (None, "", 7), (2, None, 8), (3, "9" * 100_000, 9)], "doc_id long, text string, pii_spans int")
    got = pii.pseudonymize(docs, b"key").collect()
    assert sorted((r.doc_id or 0, r.text or "", len(r.pii_spans)) for r in got) == sorted([(1, new, 6), (1, new, 6), (0, "", 0), (2, "", 0), (3, "9" * 100_000, 0)])
    assert pii.pseudonymize(nothing, b"key").count() == 0


@pytest.mark.parametrize(("kind", "value", "after"), [
    ("card", "4111 1111 1111 1111", " 12/25"), ("card", "4111111111111111", " 08/27"), ("card", "5500005555555559", " 123"),
    ("card", "4111-1111-1111-1111", " 123"), ("card", "4111-1111-1111-1111", "-123"), ("card", "4111-1111 1111-1111", ""),
    ("iban", "AT611904300234573201", " EUR"), ("iban", "ES91 2100 0418 4502 0005 1332", " BIC"), ("iban", "DE89 3704 0044 0532 0130 00", " EUR 25"),
    ("phone", "+1 (017) 555-7713", " 24"), ("phone", "+1 017 555 7713", " 24"), ("phone", "+10175557713", " 24"), ("phone", "+44 (020) 7946-0958", " 24"),
    ("iban", "de89 3704 0044 0532 0130 00", " eur"), ("iban", "at611904300234573201", " and"), ("phone", "0044 20 7946 0958", " of"),
    ("phone", "001 212 555 0123", " 24"), ("phone", "00351-912-345-678", " 24"),
    ("phone", "+491701234567", " 24"), ("phone", "+49 30-1234 5678", ""), ("phone", "+49 30 1234 5678", " of"),
])
def test_pii_followed_by_numbers_and_words(kind, value, after):
    names = pii.Pseudonyms(b"key")
    alone, spans = names.replaced(value)
    assert spans == [(kind, 0, len(value))] and alone != value
    assert names.replaced(f"is {value}{after} x") == (f"is {alone}{after} x", [(kind, 3, 3 + len(value))])


def test_pii_links_equal_values():
    """Every separator style of a number is one value with one country code, and capitals do not part e-mail names."""
    names = pii.Pseudonyms(b"key")
    for code, styles in (("44", ["+442079460958", "+44 20 7946 0958", "+44-20-7946-0958", "+44 (20) 7946 0958", "+4420 7946 0958"]),
                         ("49", ["+4915123456789", "+49 151 2345 6789", "+49-151-2345-6789"]),
                         ("1", ["+12125550123", "+1 212 555 0123", "+1 (212) 555-0123", "+1.212.555.0123"]),
                         ("351", ["+351912345678", "+351 912 345 678"])):
        found = {re.sub(r"\D", "", names.phone(s)) for s in styles}
        assert len(found) == 1 and found.pop().startswith(code)
    assert names.phone("0044 20 7946 0958") == "00" + names.phone("+44 20 7946 0958")[1:]
    assert names.iban("de89 3704 0044 0532 0130 00") == names.iban("DE89 3704 0044 0532 0130 00").lower()
    assert names.email("Alice.B@x.com").lower() == names.email("alice.b@X.com").lower()
    assert [c.isupper() for c in names.email("Alice.B@x.com")] == [c.isupper() for c in "Alice.B@x.com"]


def test_pii_permutes_whole_domains():
    """Each kind is a bijection of its valid values, tried on whole domains or on all values of a few places."""
    names = pii.Pseudonyms(b"key")
    days = [pii.FIRST_DAY.fromordinal(pii.FIRST_DAY.toordinal() + k).isoformat() for k in range((pii.LAST_DAY - pii.FIRST_DAY).days + 1)]
    assert sorted(names.date(d) for d in days) == days
    assert len({names.phone(f"+44 20 7946 {k:04d}") for k in range(3000)}) == 3000
    assert sorted(names.digits(f"{k:04d}", "t") for k in range(10_000)) == [f"{k:04d}" for k in range(10_000)]
    assert len({names.email(f"{a}{b}7@x.org") for a in "abcdefghij" for b in "klmnop"}) == 60
    bodies = [f"41111111111{k:04d}" for k in range(2000)]
    cards = {names.card(b + pii.luhn_digit(b)) for b in bodies}
    assert len(cards) == 2000 and all(pii.luhn_digit(c[:-1]) == c[-1] for c in cards)
    addresses = {names.ipv4(f"10.0.{a}.{b}") for a in range(8) for b in range(256)}
    assert len(addresses) == 2048 and all(max(map(int, a.split("."))) < 256 for a in addresses)
    numbers = {names.ssn(f"{a:03d}-07-{b:04d}") for a in (1, 665, 667, 899) for b in range(1, 500)}
    assert len(numbers) == 4 * 499 and not any(s[:3] in ("000", "666") or s[:3] > "899" or "-00-" in s or s.endswith("0000") for s in numbers)


def test_cleaning_judges_rows_without_ids(spark):
    """NULL item ids search, rows are judged by their own text, and one of a group without ids stays."""
    passage = " ".join(f"word{k}" for k in range(12))
    items = spark.createDataFrame([(None, passage), (1, "none of this is there at all or anywhere")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "clean text"), (1, f"x {passage} y"), (None, passage), (None, "also clean"), (3, None)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.n_shared) for r in decontaminate.find(docs, items).collect()}
    assert found == {(1, None, 8), (None, None, 8)}
    left = sorted((r.doc_id or 0, r.text or "") for r in decontaminate.clean(docs, items).collect())
    assert left == [(0, "also clean"), (1, "clean text"), (3, "")]
    base = [f"w{k}" for k in range(60)]
    rows = [(None, " ".join(base)), (None, " ".join([*base, "tail"])), (None, "another text of several words here"), (9, " ".join([*base[:30], "q", *base[30:]]))]
    near = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in jaccard.clean(near).collect()) == [0, 9]
    assert jaccard.clean(near.filter("doc_id IS NULL")).count() == 2


def test_toxicity(spark, nothing):
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        own = words(rng, rng.randint(5, 80))
        toxic = i % 8 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                own.insert(rng.randrange(len(own)), rng.choice(["scum", "Idiot,", "vequé", "vequon"]))
        rows.append((i, " ".join(own), int(toxic)))
    docs = spark.createDataFrame([(i, t, 0.0) for i, t, _ in rows] + [(None, None, 1.0), (3000, "", 1.0)], "doc_id long, text string, p_toxic double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 2] + [(i, 1, y) for i, _, y in rows if i % 16 == 0] + [(5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, labels, toxicity.label_categories())
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    assert len(got) == len(rows) + 2
    held = [(y, got[i].p_toxic >= toxicity.REJECT) for i, _, y in rows if not i % 2 and i % 16]
    assert sum(y and r for y, r in held) >= 0.95 * sum(y for y, _ in held) and not any(r and not y for y, r in held)
    assert all(r.p_poor < 0.01 for r in got.values())  # a category of a single class
    none = toxicity.score(docs, toxicity.train(docs, labels.filter("1 = 0"), toxicity.label_categories()))
    assert none.filter("p_toxic > 0.01").count() == 0 and toxicity.score(nothing, chain).count() == 0
    assert toxicity.clean(docs, labels).columns == docs.columns


def test_toxicity_of_long_texts(spark):
    """Texts of many clean words stay, and texts that hold a toxic one go, wherever it is."""
    rng = random.Random(12)
    scum = ["scum", "idiot", "moron"]
    rows = []
    for i in range(1600):
        own = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(40)] + (scum if i % 8 == 0 else [])
        rng.shuffle(own)
        rows.append((i, " ".join(own)))
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    chain = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, toxicity.label_categories())
    strange = [" ".join("".join(rng.choice("qrstuvwxyz") for _ in range(9)) for _ in range(100_000)) for _ in range(4)]
    texts = [*strange, *(f"{s[:at]} {' '.join(scum)} {s[at:]}" for s in strange[:2] for at in (0, 499_999, len(s)))]
    got = {r.doc_id: r.p_toxic >= toxicity.REJECT for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), chain).collect()}
    assert [got[i] for i in range(len(texts))] == [False] * 4 + [True] * 6


def test_later_models_see_chances_of_models_that_left_a_row_out(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.train(docs, labels, toxicity.label_categories())
    assert [len(w) - (1 << toxicity.BITS) for w in chain.weights] == [1, 2]
