from __future__ import annotations

import datetime
import hashlib

import regex as re

from lectern.llm.pseudonyms import ANY, KINDS, pseudonymise

from .helpers import SF, awkward, frames, same_rows

KEY = "a test key"
VALUES = ("Jane.Doe99@mail.example.com +1 (017) 555-7713 | 017-555-7713 4111 1111 1111 1111 4111111111111111 10.20.30.40 1980-02-28 28/02/1980 123-45-6789")
INVALID = "4111111111111112 256.1.1.1 1980-02-30 000-12-3456 666-12-3456 1.2.3.4.5 1850-01-01 12345678901 jane@ @x 99999999999999999999"


def luhn(s: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(s)):
        v = int(c)
        total += v if k % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def run(spark, *texts: str | None) -> list:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pseudonymise(docs, KEY).sort("doc_id").collect()]


def test_formats_links_and_validity(spark):
    a, b, c = run(spark, f"x {VALUES} y", f"other words\n{VALUES}", INVALID)
    assert c.text == INVALID and c.n_private == 0
    assert a.text.removeprefix("x ").removesuffix(" y") == b.text.removeprefix("other words\n")
    assert (a.n_email, a.n_ip, a.n_date, a.n_ssn, a.n_phone, a.n_card, a.n_private) == (1, 1, 2, 1, 2, 2, 9)
    m = re.fullmatch(
        r"x ([a-z]{4}\.[a-z]{3}\d\d)@mail\.example\.com \+1 \((\d{3})\) (\d{3}-\d{4}) \| (\d{3})-(\d{3}-\d{4}) ((?:\d{4} ){4})(\d{16}) "
        r"(\d+\.\d+\.\d+\.\d+) (\d{4}-\d\d-\d\d) (\d\d/\d\d/\d{4}) (\d{3}-\d\d-\d{4}) y", a.text)
    assert m, a.text
    assert m[2] == m[4] and m[3] == m[5] and m[6].replace(" ", "") == m[7] and luhn(m[7])
    day = datetime.date.fromisoformat(m[9])
    assert day.strftime("%d/%m/%Y") == m[10] and 1900 <= day.year <= 2099
    assert all(int(x) <= 255 for x in m[8].split("."))
    assert m[11][:3] not in ("000", "666") and m[11][0] != "9" and m[11][4:6] != "00" and m[11][7:] != "0000"
    assert not any(v in a.text for v in ("ane.", "017", "555-7713", "4111", "10.20.30.40", "1980", "123-45"))


def test_different_values_stay_different(spark):
    days = [datetime.date(1999, 1, 1) + datetime.timedelta(i) for i in range(300)]
    texts = [f"{d} 10.0.{i % 256}.{i // 256} 212-555-{i:04d} 123-45-{i + 1:04d} u{i}@x.org" for i, d in enumerate(days)]
    out = [r.text.split() for r in run(spark, *texts)]
    for k in range(5):
        assert len({x[k] for x in out}) == 300


def test_keys_matter(spark):
    docs = spark.createDataFrame([(1, VALUES)], "doc_id long, text string")
    assert pseudonymise(docs, "one").first().text != pseudonymise(docs, "two").first().text


def test_long_and_joined_values(spark):
    long = "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz.1@x.org"
    a, b, c, d = run(spark, long, "7536784127813050 4845168114407329", "a" * 300_000 + " 4111111111111111 " + "1" * 100_000, "für.26@mail6.example.com")
    assert re.fullmatch(r"[a-z]{52}\.\d@x\.org", a.text) and a.text != long
    assert b.n_card == sum(map(luhn, "7536784127813050 4845168114407329".split()))
    assert len(c.text) == 300_000 + 18 + 100_000 and c.n_card == 1
    assert d.text != "für.26@mail6.example.com" and re.fullmatch(r"[a-z]ü[a-z]\.\d\d@mail6\.example\.com", d.text)


def test_awkward_rows_stay(spark):
    docs, clashing, empty = frames(spark)
    want = [(i, t) for i, t, *_ in awkward()]
    for frame in (docs, clashing):
        assert same_rows(want, [(r.doc_id, r.text) for r in pseudonymise(frame, KEY).collect()])
    assert pseudonymise(empty, KEY).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    old = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    linked: dict[str, str] = {}
    for r in pseudonymise(docs, KEY).collect():
        assert (r.text == old[r.doc_id]) == (r.n_private == 0)
        for p in (r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", r"\+1 \(\d{3}\) \d{3}-\d{4}"):
            before, after = re.findall(p, old[r.doc_id]), re.findall(p, r.text)
            assert len(before) == len(after)
            for u, v in zip(before, after, strict=True):
                assert linked.setdefault(u, v) == v
                if len(u) == 16:
                    assert luhn(u) == luhn(v) and (luhn(u) or u == v)
    assert len(set(linked.values())) == len(linked)


def prf(secret: str, tweak: str, i: int, x: int) -> int:
    return int(hashlib.sha256(f"{secret}/{tweak}/{i}/{x}/{secret}".encode()).hexdigest()[:15], 16)


def network(x: int, mx: int, y: int, my: int, secret: str, tweak: str) -> tuple[int, int]:
    for i in range(8):
        if i % 2 == 0:
            x = (x + prf(secret, tweak, i, y) % mx) % mx
        else:
            y = (y + prf(secret, tweak, i, x) % my) % my
    return x, y


def symbols(s: str, base: int, secret: str, tweak: str) -> str:
    letters = "0123456789" if base == 10 else "abcdefghijklmnopqrstuvwxyz"
    piece = 34 if base == 10 else 24

    def number(c: str) -> int:
        v = 0
        for k in c:
            v = v * base + letters.index(k)
        return v

    def written(v: int, n: int) -> str:
        out = ""
        for _ in range(n):
            v, k = divmod(v, base)
            out = letters[k] + out
        return out

    out = ""
    for i in range(0, len(s), piece):
        p = s[i : i + piece]
        h = len(p) // 2
        x, y = network(number(p[:h]), base**h, number(p[h:]), base ** (len(p) - h), secret, f"{tweak}/{len(s)}/{i // piece}")
        out += written(x, h) + written(y, len(p) - h)
    return out


def fill(form: str, pattern: str, new: str) -> str:
    new = iter(new)
    return re.sub(pattern, lambda _: next(new), form)


def brute(m: str, secret: str) -> tuple[str | None, str]:
    """(kind, pseudonym) of one match, by an implementation of its own."""
    digits = re.sub("[^0-9]", "", m)
    if "@" in m:
        local, domain = m.lower().split("@")[0], m.split("@")[-1]
        local = fill(local, "[a-z]", symbols(re.sub("[^a-z]", "", local), 26, secret, "email"))
        return "email", fill(local, "[0-9]", symbols(digits_of(m.lower().split("@")[0]), 10, secret, "email")) + "@" + domain
    if re.fullmatch(KINDS["ip"], m):
        o = [int(x) for x in m.split(".")]
        if max(o) > 255:
            return None, m
        x, y = network(o[0] * 256 + o[1], 65536, o[2] * 256 + o[3], 65536, secret, "ip")
        return "ip", f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    if re.fullmatch(KINDS["date"], m):
        try:
            day = datetime.datetime.strptime(m, "%d/%m/%Y" if m[2] == "/" else "%Y-%m-%d").date()
        except ValueError:
            return None, m
        if not 1900 <= day.year <= 2099:
            return None, m
        v = (day - datetime.date(1900, 1, 1)).days
        while True:
            x, y = network(v % 271, 271, v // 271, 270, secret, "date")
            v = y * 271 + x
            if v < 73_049:
                break
        day = datetime.date(1900, 1, 1) + datetime.timedelta(v)
        return "date", day.strftime("%d/%m/%Y") if m[2] == "/" else day.isoformat()
    if re.fullmatch(KINDS["ssn"], m):
        area, group, serial = int(m[:3]), int(m[4:6]), int(m[7:])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None, m
        x, y = network([a for a in range(1, 900) if a != 666].index(area), 898, (group - 1) * 9999 + serial - 1, 99 * 9999, secret, "ssn")
        return "ssn", f"{[a for a in range(1, 900) if a != 666][x]:03d}-{y // 9999 + 1:02d}-{y % 9999 + 1:04d}"
    if re.fullmatch(KINDS["phone"], m):
        return "phone", fill(m, "[0-9]", digits[:-10] + symbols(digits[-10:], 10, secret, "phone"))
    if not luhn(digits):
        return None, m
    payload = symbols(digits[:-1], 10, secret, "card")
    return "card", fill(m, "[0-9]", payload + next(c for c in "0123456789" if luhn(payload + c)))


def digits_of(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def test_against_an_implementation_of_its_own(spark):
    values = [f"{VALUES} {INVALID} 31/12/1999 12/31/1999 2099-12-31 1900-01-01 899-99-9999 665-01-0001 667-01-0001 001-01-0001 A.b_c%d+9@x.co 1.2.3.4 4222222222222"]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += list(enumerate(values, 10_000_000))
    got = {r.doc_id: r for r in pseudonymise(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), KEY).collect()}
    for d, t in docs:
        kinds = dict.fromkeys(KINDS, 0)

        def one(m, kinds=kinds) -> str:
            kind, new = brute(m[0], KEY)
            if kind:
                kinds[kind] += 1
            return new

        want = re.sub(ANY, one, t)
        assert got[d].text == want
        assert {k: got[d][f"n_{k}"] for k in KINDS} == kinds


def test_dates_depend_on_the_whole_key(spark):
    docs = spark.createDataFrame([(i, f"{1950 + i}-03-04") for i in range(60)], "doc_id long, text string")
    a, b = ([r.text for r in pseudonymise(docs, k).sort("doc_id").collect()] for k in ("company-prod-key", "company-test-key"))
    assert sum(x == y for x, y in zip(a, b, strict=True)) <= 1 and len(set(a)) == 60


def test_values_of_any_length(spark):
    many = "x@" + "a." * 100_000 + "org"
    out = run(spark, many, "1.2." * 100_000, "x@a." + "b" * 100_000, "4-" * 100_000)
    assert out[0].n_email == 1 and out[0].text.endswith(many[2:]) and out[2].n_email == 1
