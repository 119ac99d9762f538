"""Whitening, URL rules and conversation repair against brute force, known answers and odd inputs."""

import collections
import fractions
import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from tessera.llm import turn_repair, url_rules, whitening

SF = "/root/testdata/sf0.001"


def counted(rows):
    return collections.Counter(map(tuple, rows))


def same_as_sql(df, sql, *tables, at=SF):
    c = duckdb.connect()
    for t in tables:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    want = c.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    i = [want.columns.index(x) for x in cols]
    assert counted(df.select(*cols).collect()) == counted(tuple(r[k] for k in i) for r in want.fetchall())


# ---------------------------------------------------------------- whitening


def brute(vectors, components=8):
    """By fractions: n, deviations, V; then numpy for the vectors of V."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * r[i] - s[i] for i in range(d)] for r in x]
    v = [[fractions.Fraction(sum(r[i] * r[j] for r in z), n**3) for j in range(d)] for i in range(d)]
    e, axes = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    w = np.array([[float(fractions.Fraction(c, n)) for c in r] for r in z]) @ axes / np.sqrt(e)
    return n, [sum(c * c for c in r) for r in z], w, e / float(sum(v[i][i] for i in range(d)))


def check_whitened(df, ids, vectors):
    n, deviations, w, explained = brute(vectors)
    k = w.shape[1]
    rows = sorted(df.collect(), key=lambda r: (r.component, ids.index(r.vec_id)))
    got = np.array([r.whitened for r in rows]).reshape(k, -1).T
    signs = np.sign((got * w).sum(0))
    assert np.abs(got - w * signs).max() < 1e-7
    assert [int(r.deviation) for r in rows[: len(ids)]] == deviations and {r.n for r in rows} == {n}
    assert np.allclose([rows[j * len(ids)].explained for j in range(k)], explained, rtol=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8


def test_whitening_query_equals_fractions(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(60).collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    check_whitened(whitening.whiten(df), [i for i, _ in rows], [v for _, v in rows])
    out = whitening.op11_whitening(spark, SF)
    assert dict(out.dtypes)["deviation"] == "bigint" and out.where("deviation is null").count() == 0
    total = spark.read.parquet(f"{SF}/embeddings.parquet").where("embedding is not null").count()
    assert out.count() == 8 * total and out.select("identity_error").distinct().count() == 1


def test_whitening_of_many_parts_and_large_entries_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(5) * 10.0 ** rng.integers(-3, 9)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)  # more parts than FAN
    check_whitened(whitening.whiten(df, components=5), [i for i, _ in rows], [v for _, v in rows])


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(1)
    z = rng.integers(-(2**61), 2**61, (300, 7))
    g = whitening.Gram(7)
    for part in np.array_split(z, 9):
        g.add(part)
    big = z.astype(object)
    want = big.T @ big
    assert (g.done() == want).all()
    assert all((whitening.from_digits(whitening.to_digits(r).tobytes(), 7) == r).all() for r in want)
    edge = np.full((whitening.STRIP // 2, 2), 2**54 - 1)  # all bits of all limbs set
    g = whitening.Gram(2)
    g.add(edge)
    assert (g.done() == int(2**54 - 1) ** 2 * len(edge)).all()


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, n int, w string, dim int, component int, v int, i int"
    more = (1, "x", 2, 3, 4, 5)
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0], *more), (1, [0.0, 1.0], *more), (None, [1.0, 0.5], *more), (3, [2.0, -1.0], *more), (4, None, *more), (5, [], *more), (6, [1.0, None], *more), (7, [nan, 1.0], *more), (8, [inf, 1.0], *more), (9, [1.0], *more), (10, [3.0], *more), (11, [1.0, 1.0, 1.0], *more)]
    out = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    by = collections.Counter((r.vec_id, r.n) for r in out)
    assert by == {(1, 4): 4, (None, 4): 2, (3, 4): 2, (9, 2): 1, (10, 2): 1}  # one vector of length 3 has no variance
    assert all(r.identity_error < 1e-9 for r in out)
    alike = spark.createDataFrame([(i, [0.25] * 3, *more) for i in range(5)], schema)
    assert whitening.whiten(alike).count() == 0
    assert whitening.whiten(alike.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0], *more), (2, [-1e300, 1.0], *more), (3, [5.0, 2.0], *more)], schema)
    assert whitening.whiten(huge).count() == 3 * 1 or whitening.whiten(huge).count() == 3 * 2


# ---------------------------------------------------------------- URL rules


def judged(url, rules):
    """host, path, rule, verdict, rule by rule."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        raw = re.match(r"[^/?#]*", rest)[0]
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw), re.match(r"[^?#]*", rest[len(raw) :])[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, "allow"))


ODD_URLS = [
    None, "", "no scheme", "http:/x.com/", "://", "http://", "http://com", "http://com/", "http://COM/x", "http://a.com?x=/en/", "http://a.com#/en/", "http://example.com/en/a?b#c", "https://WWW.Example.COM/en/", "https://ww.example.com/en/x",
    "ftp://www.example.com/en", "http://notexample.com/en/", "http://x.net/es/", "http://x.net/fr/é", "http://x.net/frx/", "http://net/es/a://b.com/", "http://.net/es/", "http://a..net/fr/", "http://net./es/", "http://u@x.net:80/es/", "http://x.net:80/es/", "İ://İSTANBUL.com/",
    "x://a\nb.com/\nen/", "http://" + "a." * 50_000 + "net/es/", "http://x.net/es/" + "y" * 300_000,
]


def url_table(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "k", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string, key int")


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_url_rules_equal_rule_by_rule(spark, limit):
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    urls = ODD_URLS * 2
    got = sorted(map(tuple, url_rules.filter_urls(url_table(spark, urls), rules, limit).collect()))
    assert got == [(i, *judged(u, url_rules.RULES)) for i, u in enumerate(urls)]


@pytest.mark.parametrize("how", ["file", "few bits", "join"])
def test_many_url_rules_with_colliding_digests(spark, how):
    rng = np.random.default_rng(2)
    part = lambda k: ["a", "b", "ß", "com", "org"][int(rng.integers(k))]
    rules = {(".".join(part(5) for _ in range(rng.integers(1, 4))), "".join("/" + part(3) * int(rng.integers(3)) for _ in range(rng.integers(0, 3)))): ["allow", "block"][int(rng.integers(2))] for _ in range(200)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    odd = [("", "/", "block"), (None, "/", "block"), ("com", "x", "block"), ("a/b", "/", "block"), ("com", "/", None), ("com", "/zzz", "maybe")]
    urls = ["x://" + ".".join(part(5) for _ in range(rng.integers(1, 6))) + "".join("/" + part(3) * int(rng.integers(4)) for _ in range(rng.integers(0, 4))) for _ in range(400)]
    listed = url_rules.listed(spark.createDataFrame(rules + odd + [(h.upper() if h.isascii() else h, p, "allow") for h, p, _ in rules[:20]], "host string, path string, verdict string"))
    table = url_table(spark, urls)
    out = url_rules.by_join(table, listed) if how == "join" else url_rules.by_file(table, listed, 64 if how == "file" else 3)
    assert sorted(map(tuple, out.collect())) == [(i, *judged(u, rules)) for i, u in enumerate(urls)]


def test_digests_are_those_of_spark(spark):
    from pyspark.sql import functions as F

    for s in ("", "a", "com/", "é" * 40):
        assert spark.range(1).select(F.xxhash64(F.lit(s))).first()[0] == np.array([xxhash.xxh64_intdigest(s.encode(), url_rules.SEED)], np.uint64).view(np.int64)[0]


def test_no_rules_and_no_urls(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.filter_urls(url_table(spark, ODD_URLS), none).collect()} == {"allow"}
    assert url_rules.filter_urls(url_table(spark, ["x"]).limit(0), none).count() == 0
    same_as_sql(url_rules.op12_url_filters(spark, SF), url_rules.SQL, "pages")


# ---------------------------------------------------------------- conversations


def grammar(s):
    return re.fullmatch(r"(s?(ua)+)?", s) is not None


def all_repairs(rows):
    """Least (cost, audit) by trying every choice for every row, with up to three turns put in at each place."""
    best = None
    puts = [()] + [c for n in (1, 2) for c in itertools.product("ua", repeat=n)]
    choices = [["D"] if f in (1, 2) else ["D", "K", "Ru", "Ra"] for _, f in rows]
    for edit in itertools.product(*choices):
        for put in itertools.product(puts, repeat=len(rows) + 1):
            said, audit, cost = "", "", 0
            for k, p in enumerate(put):
                said, audit, cost = said + "".join(p), audit + "I" * len(p), cost + 5 * len(p)
                if k < len(rows):
                    e, (initial, fault) = edit[k], rows[k]
                    audit += e[0]
                    said += "" if e == "D" else (initial or "-") if e == "K" else e[1]
                    cost += {"D": 2, "K": 0, "R": 1}[e[0]] + (5 if fault == 3 and e != "D" else 0)
            if grammar(said) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_search_equals_trying_everything():
    rng = np.random.default_rng(4)
    for n in (0, 1, 1, 2, 2, 2, 2, 3, 3, 3):
        for _ in range(6 if n > 2 else 12):
            rows = tuple((["s", "u", "a", "x", ""][int(rng.integers(5))], int(rng.integers(4))) for _ in range(n))
            assert turn_repair.repair(rows) == all_repairs(rows), rows


def test_blocks_give_what_one_search_gives():
    rng = np.random.default_rng(5)
    for _ in range(40):
        rows = tuple((["s", "u", "a", "x"][int(rng.integers(4))], int(rng.integers(4))) for _ in range(int(rng.integers(2, 40))))
        ways = [turn_repair.passage(rows[i : i + 5]) for i in range(0, len(rows), 5)]
        ways = turn_repair.joined([turn_repair.joined(ways[:3]), *([turn_repair.joined(ways[3:])] if ways[3:] else [])])
        assert min(ways[0][s] for s in turn_repair.ACCEPTING if ways[0][s]) == turn_repair.repair(rows)


def by_hand(rows):
    """Results for rows (conv_id, turn, role, text), damaged and repaired row by row."""
    out, of = {}, collections.defaultdict(list)
    text = lambda x: " " if x is None else str(x)
    for conv, turn, role, t in rows:
        of[conv]
        role, t = text(role), text(t)
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        if kind:
            t = "" if kind == 1 else re.sub("[.!?]", "", t) if kind == 2 else t
            role = "user" if kind == 4 else role
            of[conv] += [(turn, role, t)] * (2 if kind == 3 else 1)
    for conv, live in of.items():
        live.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, t in live:
            solid = re.sub("[\x20\x09-\x0d]", "", t)
            faults.append(1 if not solid else 2 if (role, t) in seen else 0 if solid[-1] in ".!?" else 3)
            seen.add((role, t))
        initials = [r[1][:1] for r in live]
        cost, audit = turn_repair.repair(tuple(zip(initials, faults)))
        lines, said, i = [], "", 0
        for e in audit:
            if e == "D":
                i += 1
                continue
            letter = initials[i] if e == "K" else "a" if said[-1:] == "u" else "u"
            lines.append(({"u": "user", "a": "assistant"}[letter] if e in "RI" else live[i][1]) + ":" + ("" if e == "I" else live[i][2]))
            said, i = said + letter, i + (e != "I")
        assert grammar(said) and i == len(live)
        turns = [r[0] for r in live if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def odd_turns():
    rng = np.random.default_rng(6)
    texts = ["Yes.", "No!", "Hm", "", " \t\n", None, "a b ? \r", "Yes.", "é…", "x" * 50_000 + ".", "two\nlines."]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant", "umpire"]
    rows = []
    for conv in [None, *range(40)]:
        for _ in range(int(rng.integers(1, 9))):
            turn = None if rng.random() < 0.1 else int(rng.integers(-3, 9))
            rows.append((conv, turn, roles[int(rng.integers(len(roles)))], texts[int(rng.integers(len(texts)))]))
    rows += [(99, i, "user" if i % 3 else "assistant", f"turn {i % 400}." if i % 7 else "cut") for i in range(3000)]  # a third of all rows and more
    return rows + [(77, 5, "user", "same.")] * 700


@pytest.mark.parametrize("block", [256, 3])
def test_repairs_equal_those_by_hand(spark, block):
    rows = odd_turns()
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, k string, pos int, gone int").repartition(7)
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in turn_repair.repaired(turn_repair.damaged(df), block).collect()}
    want = by_hand(rows)
    assert got.keys() == want.keys()
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_repair_of_no_rows_and_as_sql(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repaired(turn_repair.damaged(none)).count() == 0
    one = turn_repair.repaired(turn_repair.whole(spark.createDataFrame([(1, 0, "user", "Hi?"), (1, 9, "assistant", "Yes.")], none.schema))).first()
    assert (one.gaps, one.cost, one.audit) == (8, 0, "KK") and one.repaired_sha256 == hashlib.sha256(b"user:Hi?\nassistant:Yes.").hexdigest()
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    gone = turn_repair.repaired(turn_repair.damaged(spark.createDataFrame([(dropped, 0, "user", "Hi?")], none.schema))).first()
    assert tuple(gone) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    wide = turn_repair.repaired(turn_repair.whole(spark.createDataFrame([(1, -(2**63), "user", "Hi?"), (1, 2**63 - 1, "assistant", "Yes.")], none.schema))).first()
    assert wide.gaps == 2**63 - 1
    same_as_sql(turn_repair.op13_turn_repair(spark, SF), turn_repair.SQL, "conversations")
