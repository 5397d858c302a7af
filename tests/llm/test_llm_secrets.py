"""Secret scan against a plain program, on odd texts and on hot values."""

import hashlib
import random
import re

import pytest

from ordermill.llm import queries, secrets

SAMPLE = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string, found string, hash string, kind string"
NAMES = "password|passwd|secret|token|api_?key"


def base_spans(text):
    """The contract's patterns, read literally."""
    text, out = text or "", []
    for m in re.finditer(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text,
                         re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), m[2]))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        out += [(m.start(), kind, m.end(), m[0]) for m in re.finditer(pattern, text)
                if len(m[0]) >= least]
    return sorted(out)


def key_spans(text):
    left = list(text or "")
    for start, _, end, _ in base_spans(text):
        left[start:end] = " " * (end - start)
    return [(m.start(), 3, m.end(), m[0])
            for m in re.finditer("[A-Za-z0-9+/_-]{20,}={0,2}", "".join(left))
            if len(re.findall("[0-9]", m[0])) >= 3 and len(re.findall("[A-Za-z]", m[0])) >= 3
            and len(set(m[0])) >= 10]


def plain(rows):
    """(doc_id, base, spans) of (doc_id, text, source) rows."""
    found = [(r, base_spans(r[1]) + key_spans(r[1])) for r in rows]
    places = {}
    for (doc_id, _, source), spans in found:
        for *_, value in spans:
            places.setdefault(value, set()).add((source, doc_id))

    def live(value):
        return len({s for s, _ in places[value]}) <= 2 and len(places[value]) <= 100

    def listed(spans):
        return ",".join(f"{secrets.ORDER[k]}:{s}:{e}" for s, k, e, _ in spans)
    return [(r[0], listed(sorted(x for x in spans if x[1] < 3)),
             listed(sorted(x for x in spans if x[1] < 3 or live(x[3])))) for r, spans in found]


def scanned(spark, rows):
    """Other columns have names that the operator uses itself."""
    table = spark.createDataFrame([(*r, "f", "h", "k") for r in rows], SCHEMA)
    from pyspark.sql import functions as F
    return [tuple(r) for r in secrets.scan(table).select(
        "doc_id", secrets.span_list(F.col("findings"), True),
        secrets.span_list(F.col("findings"))).collect()]


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_odd_texts(spark):
    key, number = "aB3dE5fG7hJ9kL2mN4pQ", "0123456789abcdef" * 2
    texts = [
        None, "", " \n\t", "password", "password=", "PassWord = 'hunter22x'", "token=short",
        'token: secret="abcdefghij"', "secret=token=abcdefgh", "api_key:apikey=12345678",
        "tokentoken=12345678 passwd:password:", "API-KEY=12345678", "ſecret=12345678", "toKen=12345678",
        "AKIA" + "A" * 11, "AKIA" + "A" * 12, "AKIAAKIA" + "B1" * 5, "xAKIA" + "Z9" * 8 + "a",
        number, number[:-1], "g" + number * 3 + "G", f"token={number}", f"été 漢字 😀 {key} {number}", key,
        f"{key}==,{key}", f"{number}ABC{key}", key + "." + key, f"secret={key}{key}", "\x00" + key,
        " ".join(f"token=abcdefg{i % 10}" for i in range(1_500)), "=" * 50, "abcd" * 20 + "123"]
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)]
    same(scanned(spark, rows), plain(rows))


def test_ids_copies_and_owners(spark):
    keys = [hashlib.sha256(bytes([i])).hexdigest()[:30].upper() + "x" for i in range(4)]
    rows = [(1, keys[0], "a"), (1, keys[0], "a"), (1, keys[0], "b"), (None, keys[0], None),
            (None, keys[0], None), (2, keys[1], "a"), (3, keys[1], "b"), (4, keys[1] + " " + keys[2], None),
            (5, keys[2], None), (6, None, None), (None, None, None), (7, keys[3], "a")]
    rows += [(100 + i, f"see {keys[3]}", "a") for i in range(101)]  # too many repositories
    rows += [(300, keys[2] + f" token={keys[1]}", "a")] * 50  # copies of a row are one repository
    got = scanned(spark, rows)
    same(got, plain(rows))
    by_id = {r[0]: r[2] for r in got}
    assert by_id[7] == "" and by_id[5] == "key:0:31" and by_id[2] == ""


def test_random_texts(spark):
    pick = random.Random(5)
    parts = ["token", "secret", "PASSWORD", "api_key", "=", ":", " ", '"', "'", "AKIA", "abc12345", "é", "\n",
             "0a1b2c3d" * 4, "Zz9" * 7, "ABCDEF0123456789", ".", "-", "x"]
    rows = [(i, "".join(pick.choices(parts, k=pick.randrange(60))), pick.choice("abc"))
            for i in range(400)]
    same(scanned(spark, rows), plain(rows))


def test_query_and_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet")
            .select("doc_id", "text", "source").collect()]
    want = {d: (hashlib.sha256(b.encode()).hexdigest(), s) for d, b, s in plain(rows)}
    table = queries.op11_secrets(spark, SAMPLE)
    got = {r["doc_id"]: (r["base_sha256"], r["spans"]) for r in table.collect()}
    assert got == want and any(s for _, s in want.values())
    empty = spark.createDataFrame([], SCHEMA)
    assert secrets.scan(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000, 70_000])
def test_running_sums(spark, n):
    from pyspark.sql import functions as F
    numbers = spark.range(1).select(F.expr(
        f"transform(sequence(1, {n}), i -> bigint(i % 7))" if n else "array()")
        .cast("array<bigint>").alias("a"))
    got = numbers.select(secrets.running(F.col("a"))).first()[0]
    total, want = 0, []
    for i in range(1, n + 1):
        total += i % 7
        want.append(total)
    assert got == want
