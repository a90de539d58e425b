"""Personal data and secrets: patterns against plain regular expressions, the model, the layers."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import duckdb
import time
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest

from starloom.llm import crf, pii, secret_scan
from tests.conftest import SF_SMALL
from tests.llm.data import clashing, frame, rows

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SECRETS = {"assign": r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def plain_pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if ((kind == "ip" and any(int(x) > 255 for x in m[0].split(".")))
                    or (kind == "card" and not (14 <= len(d) <= 19 and luhn(d)))
                    or (kind == "phone" and not 10 <= len(d) <= 15)):
                continue
            out.append((kind, *m.span()))
    return sorted(out)


def plain_secrets(text):
    out = []
    for kind, pattern in SECRETS.items():
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                out.append((kind, *m.span()))
    return sorted(out)


def personal(rng):
    d = [rng.randint(0, 9) for _ in range(15)]
    card = next(s for x in range(10) if luhn(s := "".join(map(str, d)) + str(x)))
    return {"email": f"{rng.choice(['ann', 'bo.li', 'c_d'])}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
            "ip": ".".join(str(rng.randint(0, 255)) for _ in range(4)), "card": card,
            "phone": f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"}


def planted(n=120):
    rng, out = random.Random(4), []
    for i, (_, t, *rest) in enumerate(rows(6, n)[:n]):
        w = (t or "").split(" ")
        if i % 3 == 0:
            for v in personal(rng).values():
                w.insert(rng.randrange(len(w) + 1), v)
        out.append((i, " ".join(w), *rest))
    return out


def test_patterns_equal_plain_ones():
    rng = random.Random(1)
    texts = ["".join(rng.choice("a.1@2-+ %5_(9).0\n") for _ in range(rng.randint(0, 70))) for _ in range(8000)]
    texts += [t or "" for _, t, *_ in rows()] + ["1.2.3.4.5.6.7.8", "a@b.c@d.e", "@a.b", "999.1.1.1 00255.0.0.0256.1.1.1"]
    for t in texts:
        assert sorted(pii.base_spans(t)[0]) == plain_pii(t)
    texts = ["".join(rng.choice("a1fF=: \"'tokensecretAKIA0Z") for _ in range(rng.randint(0, 90))) for _ in range(4000)]
    texts += ["TOKEN = 'abcdefghijkl'", "api_key:ABCdef123456", "paſſword=abcdefghijkl", "AKIA" + "Q" * 14, "f" * 16]
    for t in texts:
        assert sorted(secret_scan.scan(t)) == plain_secrets(t)


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 500_000 + "1" * 500_000)[0] == []
    assert pii.base_spans("a" * 500_000 + "@b.cc")[0] == [("email", 0, 500_005)]


def test_gradients():
    m = crf.new_model(7, 5, 4, 3)
    rng = np.random.default_rng(0)
    m = {k: rng.standard_normal(v.shape) * 0.5 for k, v in m.items()}
    x, y = rng.integers(0, 7, (6, 4)), rng.integers(0, 5, (6, 4))
    _, g = crf.gradient(m, x, y)
    for k in m:
        i = tuple(rng.integers(0, s) for s in m[k].shape)
        old, sides = m[k][i], []
        for h in (1e-2, -1e-2):
            m[k][i] = old + h
            sides.append(crf.gradient(m, x, y)[0])
        m[k][i] = old
        assert (sides[0] - sides[1]) / 2e-2 == pytest.approx(float(g[k][i]), abs=2e-3)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    m = {k: rng.standard_normal(v.shape) for k, v in crf.new_model(5, 3, 3, 2).items()}
    x = rng.integers(0, 5, (2, 5))
    e, _ = crf.emissions(m, x.T)
    got = crf.decode(m, x)
    for b in range(2):
        paths = np.array(np.meshgrid(*[range(3)] * 5, indexing="ij")).reshape(5, -1).T
        score = [m["s"][p[0]] + sum(e[t, b, p[t]] for t in range(5)) + sum(m["A"][p[t], p[t + 1]] for t in range(4)) for p in paths]
        assert got[b].tolist() == paths[int(np.argmax(score))].tolist()


def test_windows_are_reconciled():
    tags = np.zeros((2, pii.WIDTH), np.int8)
    tags[0, 40:64] = 8
    tags[0, 40] = 7  # the first window sees the span's beginning, the second all of it but one character
    tags[1, 9:30] = 8
    assert pii.reconciled(100, [0, 32], tags) == [("phone", 40, 62)]


def test_model_learns_spans():
    """Trained on some documents, the model alone finds most of the patterns' spans in others."""
    data = [t for _, t, *_ in planted()]
    found = sorted({r[1:] for t in data[:80] for r in pii.labelled_windows(t)})
    model = pii.fit(found[:500], epochs=12)
    hit = total = extra = 0
    for t in data[80:]:
        base = set(pii.base_spans(t)[0])
        starts = pii.window_starts(t)
        own = set(pii.reconciled(len(t), starts, crf.decode(model, pii.char_ids([t[s:s + pii.WIDTH] for s in starts])))) \
            if starts else set()
        hit, total, extra = hit + len(base & own), total + len(base), extra + len(own - base)
    assert total > 30 and hit / total > 0.7
    assert pii.found_in(["Reach me at (743) 555-3824 today"], model)[0][0] == []


def test_personal_data_query(spark):
    data = planted(60) + rows()
    got = pii.report(clashing(frame(spark, data))).collect()
    want = Counter()
    for d, t, *_ in data:
        base = plain_pii(t or "")
        want[(d, *(sum(k == s[0] for s in base) for k in pii.KINDS),
              hashlib.sha256(pii.joined(base).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        spans = r["spans"].split(",") if r["spans"] else []
        assert len(spans) >= sum(r[1:5])
    assert pii.report(frame(spark, [])).count() == 0


WRITTEN_OUT = ["Please write to john.doe (at) example.com for more of it", "or to mary.major at mail.example.org today"]


def written_out():
    rng = random.Random(9)
    names, hosts = ["john.doe", "ann", "bo.li", "mary.major", "c_d"], ["example.com", "mail.example.org", "host.example.net"]
    return [f"{rng.choice(['Please write', 'mail', 'or send'])} to {rng.choice(names)}@{rng.choice(hosts)} "
            f"{rng.choice(['today', 'for more of it', 'at once'])}" for i in range(150)] + list(WRITTEN_OUT)


def test_written_out_addresses_without_digits(spark):
    """They are trained on, so the windows that hold them are decoded, in texts without any digit or @ sign."""
    data = [(i, t, "en", "s", 1) for i, t in enumerate(written_out()[:150])]
    data += [(1000 + i, t, "en", "s", 1) for i, t in enumerate(WRITTEN_OUT)]
    data.append((2000, "we met at noon and looked at the river", "en", "s", 1))
    got = {r["doc_id"]: r["spans"] for r in pii.report(frame(spark, data)).collect()}
    for i, t in enumerate(WRITTEN_OUT):
        a = t.index(" to ") + 4
        kind, x, y = got[1000 + i].split(":")
        assert kind == "email" and a <= int(x) < int(y) <= len(t) and "at" in t[int(x):int(y)]
    assert got[2000] == ""


SECRET = 'password = "hunter2hunter2hunter2"'


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


@pytest.mark.parametrize("wrap", [
    b64, lambda s: urllib.parse.quote(s, safe=""), lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: "".join(f"&#{ord(c)};" for c in s), lambda s: b64(gzip.compress(s.encode())),
    lambda s: b64(bz2.compress(s.encode())), lambda s: b64(lzma.compress(s.encode())),
    lambda s: "".join(f"%{b:02X}" for b in b64("x " + b64(s) + " y").encode()),
    lambda s: b64(gzip.compress(b64(urllib.parse.quote(s)).encode())),
    lambda s: urllib.parse.quote(urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""), safe="")])
def test_layers_are_unwrapped_and_mapped(wrap):
    inner = wrap(SECRET)
    text = f"before ñ 東 {inner} after"
    base, more, layers = secret_scan.findings(text)
    assert sorted(base) == plain_secrets(text) and layers >= 1
    assert any(k == "assign" for k, _, _ in more)
    at = text.index(inner)
    assert all(at <= a < b <= at + len(inner) for _, a, b in more)


def test_base64_places_are_narrow():
    text = b64("nothing to see here, " + SECRET + " and nothing more of it here")
    (_, a, b), = secret_scan.findings(text)[1]
    assert base64.b64decode(text[a:b]).decode().startswith("password = ") and b - a < 56


def test_cycles_end_and_plain_text_stays_plain():
    text = "%25252541 %25 " + "a%41" * 50 + " " + b64("%2541 " + b64("plain words, nothing more"))
    assert secret_scan.findings(text)[:2] == ([], []) and secret_scan.findings(text)[2] >= 4
    work = secret_scan.Unwrapper("loop")
    for _ in range(3):  # a layer that comes again, as from an archive of itself, isn't queued again
        work.push(secret_scan.Layer("again"))
    assert len(work.queue) == 2
    assert secret_scan.findings("Entlichkeitenverschwerungen INTERNATIONALISIERUNG schreibmaschine")[2] == 0


@pytest.mark.parametrize("wrap", [
    b64, lambda s: urllib.parse.quote(s, safe=""), lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: b64(gzip.compress(s.encode(), mtime=0)), lambda s: b64("x " + b64(s) + " y")])
def test_equal_tokens_are_each_found(wrap):
    inner = wrap(SECRET)
    text = f"one {inner}\ntwo {inner}\nthree {b64(SECRET)} {wrap(SECRET + ' ')}\n{inner}"
    found = [(a, b) for k, a, b in secret_scan.findings(text)[1] if k == "assign"]
    for m in re.finditer(re.escape(inner), text):
        assert any(m.start() <= a < b <= m.end() for a, b in found)
    assert any(text.index("three") < a and b <= text.index("three") + 6 + len(b64(SECRET)) for a, b in found)


NESTED = {
    "percent": ("%" + "25" * 50_000 + "41KIA" + "Q7" * 10, 4), "digits": ("%3" * 30_000 + "%31", 4),
    "unicode": ("\\u005c" + "u005c" * 20_000 + "u0041KIA" + "Q7" * 10, 4), "entities": ("&#" + "38;#" * 20_000 + "65;KIA" + "Q7" * 10, 4),
    "mixed": ("%5cu0025" + "5cu0025" * 15_000 + "41KIA" + "Q7" * 10, 4)}


@pytest.mark.parametrize("name", NESTED)
def test_escapes_nested_thousands_deep(name):
    text, layers = NESTED[name]
    started = time.time()
    _, more, n = secret_scan.findings("x " + text + " y")
    assert time.time() - started < 10 and n == layers
    assert [s for s in more if s[0] == "access"] == ([] if name == "digits" else [("access", 2, 2 + len(text))])


@pytest.mark.parametrize("depth", range(8))
def test_every_depth_of_escapes_is_found(depth):
    text = "".join(f"%{c:02x}" for c in "straße secret: Zr5tYu8iOp2aSd".encode())
    for i in range(depth):
        text = text.replace("%", "%25") if i % 2 else text.replace("%", "\\u0025")
    assert [(k, a >= 2, b) for k, a, b in secret_scan.findings("- " + text)[1] if k == "assign"] == [("assign", True, 2 + len(text))]


def test_numbers_of_thousands_of_digits():
    """They are no address and end no query; leading zeros are none of a part's size."""
    assert pii.base_spans("1.2.3." + "0" * 5000)[0] == [("ip", 0, 5006)]
    assert pii.base_spans("1.2.3." + "9" * 5000)[0] == []
    assert pii.base_spans("000" * 3000 + "1.2.3." + "0" * 4999 + "7")[0] == [("ip", 0, 9000 + 6 + 5000)]


def test_many_spans_take_linear_time():
    text = " ".join(f"10.0.{i % 256}.{i // 256 % 256} a{i}@b.org" for i in range(50_000))
    started = time.time()
    base, failed = pii.base_spans(text)
    assert len(base) == 100_000
    assert sum(1 for _ in pii.labelled_windows(text)) == 100_000
    assert pii.added(text, base, base, failed) == [] and len(pii.added(text, base, [], failed)) == 100_000
    assert time.time() - started < 30


def test_overlapping_spans_are_set_apart_whatever_their_number():
    one = "+4915112345678 "  # a phone number whose digits may be part of a card number too
    for n in (3, 60, 300):
        text = "call +49 151 1234 5678 or a@b.de, 10.1.2.3; " * n
        windows = list(pii.labelled_windows(text))
        assert len({w for w in windows}) < 40 and all(len(t) == len(w) for _, w, t in windows)
    assert len(list(pii.labelled_windows(one * 100))) == 100


def test_decoding_all_windows_adds_next_to_nothing(monkeypatch):
    """Windows that hold nothing a span needs aren't decoded: the recall against decoding every window."""
    texts = [t for t, *_ in duckdb.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts = [t[i:i + 20_000] for t in texts for i in range(0, len(t), 20_000)]
    data = written_out()
    windows = sorted({x for t in data + texts for x in pii.labelled_windows(t)}, key=lambda x: hashlib.md5(x[1].encode()).digest())
    kinds = {k: [x[1:] for x in windows if x[0] == k][:pii.PER_KIND] for k in (*pii.KINDS, "none")}
    model = pii.fit(sorted(x for own in kinds.values() for x in own))
    texts += data + [t.replace("@", sign) for t in data[:40] for sign in (" at ", " (at) ", " AT ", " [at] ")]
    some = [more for _, more in pii.found_in(texts, model)]
    monkeypatch.setattr(pii, "window_starts", lambda t: list(range(0, max(1, len(t) - pii.STEP), pii.STEP)))
    every = [more for _, more in pii.found_in(texts, model)]
    both = sum(len(set(a) & set(b)) for a, b in zip(some, every))
    assert sum(map(len, every)) >= 10 and both >= 0.9 * sum(map(len, every))


def test_many_equal_tokens_take_linear_time():
    assert len(secret_scan.findings(f"{b64(SECRET)}\n" * 3000)[1]) == 3000


LONG = "nothing of it in this line of text\n" * 3


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("line", ["\n", "\r\n", "\n    ", "\\n", '"\n"', "\n> "])
@pytest.mark.parametrize("pack", [str.encode, lambda s: gzip.compress(s.encode()), lambda s: bz2.compress(s.encode())])
def test_wrapped_base64_is_one_token(width, line, pack):
    noise = random.Random(3)
    for shift in (0, 10, 23):  # the secret crosses a line end, or stands far behind an archive's first line
        inner = "x" * (30 + shift) + SECRET + "".join(noise.choice("ghijklmnop \n") for _ in range(400)) + "\n" + SECRET
        whole = b64(pack(inner))
        token = line.join(whole[i:i + width] for i in range(0, len(whole), width))
        text = f"-----BEGIN CERTIFICATE-----\n{token}\n-----END CERTIFICATE-----\nmore"
        found = [(a, b) for k, a, b in secret_scan.findings(text)[1] if k == "assign"]
        at = text.index(token)
        assert found and all(at <= a < b <= at + len(token) for a, b in found)
        assert len(found) == (2 if pack is str.encode else 1)


@pytest.mark.parametrize("before", ["https://host.example/q/", "https://host.example/ab/q/", "a/b-c_", "key-", "xy/", "x"])
@pytest.mark.parametrize("after", ["", "/tail", "-x.html", "/abc/defgh"])
@pytest.mark.parametrize("pack", [str.encode, lambda s: gzip.compress(s.encode()), lambda s: zlib.compress(s.encode())])
def test_base64_inside_a_path(before, after, pack):
    text = f"see {before}{b64(pack(LONG + SECRET)).rstrip('=')}{after} for it"
    assert any(k == "assign" for k, _, _ in secret_scan.findings(text)[1])


def test_long_runs_without_base64_take_linear_time():
    assert secret_scan.findings("x" * 1_000_000 + " " * 200_000 + "y" * 1_000_000)[0] == []
    assert secret_scan.findings("word\nanother\n" * 50_000 + "a_long_name_of_something\n")[0] == []


@pytest.mark.parametrize("packer", [gzip, bz2, lzma])
def test_every_member_is_scanned(packer, monkeypatch):
    z = packer.compress
    monkeypatch.setattr(secret_scan, "CHUNK", 4_000_000)
    for data in (z(b"first ") + z(SECRET.encode()), z(b"pass") + z(SECRET.encode()[4:]), z(z(b"one ") + z(SECRET.encode())),
                 z(b"x" * 100) + bytes(64) + z(SECRET.encode()), z(bytes(70_000_000) + SECRET.encode())):
        base, more, _, truncated = secret_scan.examined(f"see {b64(data)} here")
        assert [k for k, *_ in more] == ["assign"] and 4 <= more[0][1] < more[0][2] <= 4 + len(b64(data))
    monkeypatch.setattr(secret_scan, "MAX_UNPACKED", 1000)
    assert secret_scan.examined(b64(z(b"ab cd, " * 1000)))[3] and not secret_scan.examined(b64(z(b"ab cd, " * 9)))[3]


def test_secret_query(spark):
    data = rows() + [(5000, f"x {b64(SECRET)} y", "en", "s", 1), (5001, "token=abcdefabcdefabcdef", "en", "s", 1)]
    got = secret_scan.report(clashing(frame(spark, data))).collect()
    want = Counter()
    for d, t, *_ in data:
        base = plain_secrets(t or "")
        want[(d, *(sum(k == s[0] for s in base) for k in secret_scan.KINDS),
              hashlib.sha256(secret_scan.joined(base).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    assert next(r["spans"] for r in got if r["doc_id"] == 5000).startswith("assign:2:")
    assert next(r["spans"] for r in got if r["doc_id"] == 5001) == "assign:0:24,hex:6:24"
    assert secret_scan.report(frame(spark, [])).count() == 0
