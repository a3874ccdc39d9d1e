"""PII, chat formatting and URL filters against brute force on small rows."""

import hashlib
import re

import pytest

from ledgerlake.llm import chat_format, pii, url_filter

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TEXTS = [
    None, "", "a.b@c.de, x@y @z.com q@w.e.r.t..x", "a@b@c.de@f.g", "+@-.-", "é@é.com ü.x@ä-b.cd",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4 " + "9" * 5000 + ".1.1.1", "10.0.0.1.5 host 1.2.3",
    "4532 0151-1283 0366 and 4532015112830367 4532015112830366 0", "card 4111111111111111 1", "4111111111111111-",
    "+1 (555) 123-4567 +12 +1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49..30--1234567)", "++49 30 1234567",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, DE89370400440532013001",
    "ssn 123-45-6789; 123-45-6789 far away", "x" * 20000 + "@a.b " + "1" * 20000, "e\u0301 a@b.cd \U0001F600 1.1.1.1",
]


def luhn_brute(d):
    t = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (2 if i % 2 else 1)
        t += x // 10 + x % 10
    return t % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)] if len(text) < 9000 else \
        [("email", a, b) for a, b in pii._emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for kind, pat in (("card", CARD), ("phone", PHONE)):
        for m in pat.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            if (16 <= len(d) <= 19 and luhn_brute(d)) if kind == "card" else 8 <= len(d) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_equal_brute_force(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE] == brute(text)


def test_added_kinds_need_checksum_or_context():
    kinds = [s[0] for s in pii.find_spans(TEXTS[13])]
    assert kinds == ["iban", "iban"]
    assert [s[0] for s in pii.find_spans("ssn 123-45-6789")] == ["ssn"]
    assert pii.find_spans("number 123-45-6789") == []


def test_digest_rows_and_masking(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "x", 2), (None, "a@b.c", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_spans string, n_chars long")
    got = pii.digest(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            continue
        want = brute(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert r.n_email == sum(k == "email" for k, _, _ in want)
    out = {r.doc_id: r for r in pii.masked_documents(df.select("doc_id", "text", "n_chars")).collect()}
    assert out[2].text.startswith("[EMAIL], x@y") and out[0].text is None
    assert out[13].text.startswith("IBAN [IBAN] and [IBAN], DE")
    assert out[2].n_chars == len(out[2].text)
    assert pii.digest(df.limit(0)).count() == 0


CHATS = [
    (1, 0, "user", "hi <|start|>x\n<|end|>\n"), (1, 1, "assistant", "a<\\|b<"), (1, 2, "assistant", "|> two"),
    (1, 3, "user", None), (1, 4, None, "<|turn|>"), (1, 5, "us<|er\n%0A", "<"), (1, 6, "assistant", ""),
    (2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (2, None, "system", "\\<\\\\|"),
    (None, 0, "user", "x"), (3, 0, "user", "<" * 50 + "|" * 50 + "é\U0001F600" * 9000),
]


def test_chats_round_trip(spark):
    df = spark.createDataFrame([(*r, "ts", "formatted") for r in CHATS],
                               "conv_id long, turn long, role string, text string, ts string, formatted string")
    back = {r.conv_id: r for r in chat_format.read_chats(chat_format.format_chats(df)).collect()}
    digest = {r.conv_id: r for r in chat_format.digest(df).collect()}
    for conv in {c[0] for c in CHATS}:
        rows = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in CHATS if c == conv)
        assert [(t.role, t.text) for t in back[conv].turns] == [r[1:] for r in rows]
        loss = "".join(x for _, r, x in rows if r == "assistant")
        assert back[conv].loss_text == loss and digest[conv].loss_chars == len(loss)
        assert digest[conv].n_turns == len(rows)
        want = "".join(f"{r}\n{x}\n" for _, r, x in rows).encode()
        assert digest[conv].turns_sha256 == hashlib.sha256(want).hexdigest()
        runs = back[conv].loss_runs
        assert sum(r.skip + r.take for r in runs) <= len(back[conv].formatted) == digest[conv].formatted_chars
    assert back[1].formatted.count("<|start|>assistant\n") == 2       # turns 1 and 2 share a block
    assert chat_format.digest(df.limit(0)).count() == 0


URLS = [None, "", "no scheme", "http://Example.ORG/es/1?x=1", "https://a.b.example.org/en/1#y", "http://example.org",
        "http://example.org/", "ftp://fr.com/fr/9", "http://x.com/de/", "http://com/fr/a", "http://bexample.org/es/",
        "http://www.q.net/p/", "http://q.net/p.html", "http://q.net/other", "x://?q", "http://org/://com/fr/"]


def test_urls_against_brute_force(spark):
    listed = spark.createDataFrame([("q.net/p",), ("x.com/de",), (None,), ("q.net/p",)], "canonical string")
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(URLS)] + [(3, URLS[3], "k"), (None, "http://org/", "")],
                                  "page_id long, url string, key string")
    got = url_filter.judge(pages, url_filter.RULES, listed).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = (URLS[r.page_id] if r.page_id is not None else "http://org/") or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fit = [(-len(h + p), h + p, v) for v, h, p in url_filter.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        canon = re.sub(r"^(www|m)\.", "", host) + re.sub(r"(\.html?|/)$", "", path)
        verdict = min(fit)[2] if fit else "block" if host and canon in ("q.net/p", "x.com/de") else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, min(fit)[1] if fit else None, verdict), url
    assert url_filter.judge(pages.limit(0), url_filter.RULES, listed.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, [], listed.limit(0)).collect()} == {"allow"}


def test_filter_passes_every_listed_key(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS key")
    other = spark.range(20000).selectExpr("concat('z', id) AS key")
    filt = url_filter.bloom(keys, 256)
    assert url_filter.possible(keys, "key", filt, 256).count() == 2000
    assert url_filter.possible(other, "key", filt, 256).count() < 400
