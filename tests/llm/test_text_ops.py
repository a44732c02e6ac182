"""HTML extraction, chat windows, pseudonyms, URL lists."""

import hashlib
import html
import random
import re
import time
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat_format, pseudonyms
from tidemark.llm.html_extract import extract, html_extract
from tidemark.llm.url_filter import url_filter

PARA = "Some text, with commas, that is long enough to count as a paragraph of an article, number {}."


def page(body, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>'</script></head><body>{before}{body}{after}</body></html>"


def article(n=4):
    return [PARA.format(i) for i in range(n)]


@pytest.mark.parametrize("box", ["<article>{}</article>", "<div class='content'>{}</div>", "<main><div>{}</div></main>", "<div><div id=story>{}</div></div>", "<table><tr><td>{}</td></tr></table>", "<div class='post has-sidebar overflow-hidden'><div class='elementor-widget'>{}</div></div>"])
def test_article_without_the_rest(box):
    body = box.format("<h1>Title of it</h1>" + "".join(f"<p>{p}" for p in article()))
    junk = "<nav><ul><li><a href=/>Home, page</a></li></ul></nav><div class=ad>Buy, now, cheap, stuff, today</div><form><p>Mail, please, here</p></form><aside><p>Side, bar, text</p></aside><!-- <p>hidden</p> -->"
    more = "<div id='comments'><p>Nice, article, thanks, a lot, really great to read</p></div><div class='cookie-notice'>We use cookies, as all do</div><footer>&copy; us</footer>"
    assert extract(page(body, junk, more)) == "Title of it " + " ".join(article())


@pytest.mark.parametrize("text, want", [(None, ""), ("", ""), ("<nav><a href=x>y</a></nav>", ""), ("plain", "plain"), ("<article><p>a &lt;b&gt; &#233;&nbsp;\n x</p>tail</article>", "a <b> é x tail"), ("<p>a<p>b", "a b"), ("<article><p>1 < 2 and</p></article>", "1 < 2 and"), ("<article><p>x<script>if(a<b){}</script>y</p></article>", "xy")])
def test_odd_pages(text, want):
    assert extract(text) == want


@given(st.lists(st.text(alphabet="abc ,.<>&é", min_size=1, max_size=60), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_escaped_text_comes_back(paras):
    want = " ".join(x for p in paras if (x := re.sub(r"\s+", " ", p).strip()))
    assert extract("<article>" + "".join(f"<p>{html.escape(p)}</p>" for p in paras) + "</article>") == want


def test_deep_pages_and_columns(spark):
    deep = "<div>" * 5000 + f"<p>{PARA}</p>"
    rows = [(1, "u", None), (2, None, deep), (2, None, deep), (3, "u", page("<article><p>x</p></article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(html_extract(df).collect())
    assert [(r["page_id"], r["n_chars"]) for r in got] == [(1, 0), (2, len(PARA)), (2, len(PARA)), (3, 1)]
    assert html_extract(df.limit(0)).collect() == []


def test_parts_of_articles_that_look_like_others():
    words = "Some words, and more of them, as a paragraph has, in an article."
    links = "<ul>" + "<li><a href=x>Another article to read now, and one more</a></li>" * 20 + "</ul>"
    body = f"<article><header><h1>Its head</h1><p>By someone</p></header><p>{words}</p><figure><img src=x><figcaption>A caption</figcaption></figure><section class='related work'>{f'<p>{words}</p>' * 5}</section><div class='social-history section'>{f'<p>{words}</p>' * 6}</div><div class='related'>{links}</div><div class='share'>Share it</div></article>"
    got = extract(page(body, "<header><h1>Site</h1></header>", f"<div class='comments'>{'<p>Nice, I say, really nice, as ever.</p>' * 9}</div>"))
    assert got == " ".join(["Its head", words, "A caption", *[words] * 11])


def test_labelled_pages():
    """Articles in pages of several kinds: words of the article that are found, and found words that are of the article."""
    rng = random.Random(12)
    hit = got = want = 0
    for i in range(120):
        vocabulary = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(999)}" for _ in range(400)]
        text = lambda n, words: " ".join(rng.choice(words) + ("," if rng.random() < 0.1 else "") for _ in range(n))
        junk = [f"junk{j}" for j in range(50)]
        paras = [text(rng.randrange(15, 80), vocabulary) for _ in range(rng.randrange(2, 9))]
        inside = "".join(f"<p>{p}</p>" + (f"<div class='{rng.choice(['ad', 'share', 'newsletter', 'advert box'])}'>{text(6, junk)}</div>" if rng.random() < 0.3 else "") for p in paras)
        box = rng.choice(["<article>{}</article>", "<main><div class=x>{}</div></main>", "<div id=content>{}</div>", "<div><div class='post-body'>{}</div></div>", "<table><tr><td>{}</td></tr></table>"])
        side = f"<div class='sidebar'><p>{text(30, junk)}</p></div><nav>{text(9, junk)}</nav><aside>{text(30, junk)}</aside>"
        after = f"<div id='comments'>{''.join(f'<p>{text(20, junk)}</p>' for _ in range(rng.randrange(4)))}</div><footer>{text(12, junk)}</footer>"
        found, truth = re.findall(r"\w+", extract(page(box.format(inside), side, after))), re.findall(r"\w+", " ".join(paras))
        hit += len([w for w in found if not w.startswith("junk")])
        got, want = got + len(found), want + len(truth)
    assert hit >= 0.99 * want and hit >= 0.99 * got


@pytest.mark.parametrize("part, n", [("<b>", 60000), ("<b></i>", 40000), ("<div>", 60000), ("<b><p>x", 40000), ("<svg/>", 60000), ("<li>", 60000), ("<a \">", 60000), ("</p>", 60000), ("<", 300000)])
def test_hostile_pages_take_time_in_proportion(part, n):
    def seconds(k):
        begun = time.process_time()
        extract(part * k)
        return time.process_time() - begun

    seconds(n // 8)
    assert seconds(n) < 24 * max(seconds(n // 8), 0.01)


CONTROL = ["<start_of_turn>user<bos>x<eos><end_of_turn>", "</s>[INST] ok [/INST]", "<|turn|>x<|end|>\n", "␛␛<|␛", "<<SYS>>␛n", "", "plain\n\n", "[INST", "<s><s>"]


def conversation(rng, n, lead):
    rows = [(i, rng.choice(["user", "assistant"]) if i or not lead else "system", rng.choice([*CONTROL, "word " * rng.randrange(400), None])) for i in range(n)]
    return rows


def test_chat_windows(spark):
    rng = random.Random(4)
    convs = {i: conversation(rng, rng.choice([1, 2, 5, 30, 120]), i % 2 == 0) for i in range(25)}
    rows = [(i, *t) for i, turns in convs.items() for t in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(3)).withColumn("ord", F.lit("x"))
    windows = chat_format.chat_windows(df)
    got = {r["conv_id"]: r for r in chat_format.digest(windows).collect()}
    for i, turns in convs.items():
        flat = "".join(f"{r}\n{t or ''}\n" for _, r, t in turns)
        loss = "".join(t or "" for _, r, t in turns if r == "assistant")
        assert (got[i]["n_turns"], got[i]["turns_sha256"]) == (len(turns), hashlib.sha256(flat.encode()).hexdigest())
        assert (got[i]["loss_chars"], got[i]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    kept = windows.withColumn("turns", chat_format.read_turns(F.col("formatted"))).collect()
    assert max(r["window"] for r in kept) > 3 and any(r["repeated"] > 1 for r in kept)
    for r in kept:
        assert sum(m["length"] for m in r["mask"]) == len(r["formatted"])
        if convs[r["conv_id"]][0][1] == "system":
            assert r["turns"][0]["role"] == "system"
        cost = sum(-(-len(t["text"]) // 4) + 1 for t in r["turns"])
        new = r["turns"][r["repeated"] :]
        assert cost <= chat_format.BUDGET or len(new) == 1


def test_windows_are_filled(spark):
    rng = random.Random(5)
    rows = [(c, i, "system" if not i and c % 2 else rng.choice(["user", "assistant"]), "w" * rng.randrange(40, 400)) for c in range(12) for i in range(150)]
    windows = chat_format.chat_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    kept = windows.withColumn("turns", chat_format.read_turns(F.col("formatted"))).collect()
    last = {c: max(r["window"] for r in kept if r["conv_id"] == c) for c in range(12)}
    cost = [sum(-(-len(t["text"]) // 4) + 1 for t in r["turns"]) for r in kept if r["window"] < last[r["conv_id"]]]
    assert max(cost) <= chat_format.BUDGET and sum(cost) >= 0.9 * chat_format.BUDGET * len(cost) and min(cost) >= 0.75 * chat_format.BUDGET
    assert len(kept) <= 1.25 * sum(sum(-(-len(t) // 4) + 1 for c, _, _, t in rows if c == k) / (chat_format.BUDGET - chat_format.HISTORY) + 1 for k in range(12))


def test_chat_odd_rows(spark):
    rows = [(None, None, None, None), (None, None, None, None), (5, 1, "a\nb<|end|>", "x"), (5, 1, "a\nb<|end|>", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digest(chat_format.chat_windows(df)).collect()}
    assert got[None]["n_turns"] == 2 and got[5]["turns_sha256"] == hashlib.sha256(b"a\nb<|end|>\nx\n" * 2).hexdigest()
    assert chat_format.digest(chat_format.chat_windows(df.limit(0))).collect() == []


def luhn(s):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(s)))) % 10 == 0


def feistel(left, right, a, b, key, kind):
    for i in range(pseudonyms.ROUNDS):
        h = int(hashlib.sha256("|".join(map(str, (key, kind, a, b, i, right if i % 2 == 0 else left))).encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            left = (left + h) % a
        else:
            right = (right + h) % b
    return left, right


def masked(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kind", F.lit(1))
    return [r for r in pseudonyms.pseudonyms(df, key).orderBy("doc_id").collect()]


def test_cards_against_plain_feistel(spark):
    rng = random.Random(2)
    cards = ["".join(rng.choice("0123456789") for _ in range(rng.choice([13, 15, 16, 19]))) for _ in range(60)]
    got = masked(spark, [f"pay {c} now" for c in cards])
    for c, r in zip(cards, got, strict=True):
        if not luhn(c):
            assert r["text"] == f"pay {c} now" and r["n_replaced"] == 0
            continue
        body, n = c[:-1], len(c) - 1
        u = n // 2
        x, y = feistel(int(body[:u]), int(body[u:]), 10**u, 10 ** (n - u), "k", "card")
        new = f"{x:0{u}d}{y:0{n - u}d}"
        new += next(d for d in "0123456789" if luhn(new + d))
        assert r["text"] == f"pay {new} now" and r["n_card"] == 1


def test_formats_links_and_validation(spark):
    a, b, c, d, e, f, g, h = masked(spark, ["4539-5787-6362-1486 4539578763621486", "2023-02-28 28/02/2023 28.2.2023 2023-02-30", "123-45-6789 666-12-1234 10.0.0.1 300.0.0.1 1.2.3.4.5", "tel +1 (017) 555-7713.", None, "", "version 3. of 2 things", "x4539578763621486"])
    one, two = a["text"].split()
    assert re.fullmatch(r"\d{4}-\d{4}-\d{4}-\d{4}", one) and one.replace("-", "") == two != "4539578763621486" and luhn(two)
    iso, slash, dot, bad = b["text"].split()
    moved = date.fromisoformat(iso)
    assert slash == moved.strftime("%d/%m/%Y") and dot == f"{moved.day:02d}.{moved.month}.{moved.year}" and bad == "2023-02-30" and b["n_date"] == 3
    ssn, not_ssn, ip, not_ip, version = c["text"].split()
    assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", ssn) and not_ssn == "666-12-1234" and ip != "10.0.0.1" and all(int(x) < 256 for x in ip.split(".")) and not_ip == "300.0.0.1"
    assert re.fullmatch(r"tel \+1 \(\d{3}\) \d{3}-\d{4}\.", d["text"]) and d["n_phone"] == 1
    assert (e["text"], f["text"], g["text"], h["text"]) == (None, "", "version 3. of 2 things", "x4539578763621486") and e["n_replaced"] == 0
    assert masked(spark, ["4539578763621486"], "other key")[0]["text"] != two


PHONES = ["555-123-4567", "(555) 123-4567", "(555)123-4567", "555.123.4567", "555 123 4567", "1-800-555-1234", "+49 30 1234567", "+4930123456", "+49 (0)30 1234567", "+1 555 123 4567", "+15551234567", "+44 20 7946 0958", "0044 20 7946 0958", "030 1234567", "030/1234567", "01 23 45 67 89", "(030) 1234567", "+1 (017) 555-7713", "+420 (601) 555-7713"]
CODES = {"1-800-555-1234": "1", "+4930123456": "+49", "+15551234567": "+1", "0044 20 7946 0958": "0044"}


def test_phone_layouts(spark):
    got = masked(spark, [f"tel {p}, or" for p in PHONES])
    for p, r in zip(PHONES, got, strict=True):
        new = r["text"][4:-4]
        code = CODES.get(p) or (p.split(" ")[0] if p[0] == "+" else "")
        assert r["n_phone"] == r["n_replaced"] == 1 and new != p and new.startswith(code), p
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", p)
    same = {re.sub(r"\D", "", r["text"][4:-4])[-10:] for p, r in zip(PHONES, got, strict=True) if re.sub(r"\D", "", p)[-10:] == "5551234567"}
    assert len(same) == 1


def test_not_phones(spark):
    texts = ["0.12345678 and 1234567890", "+1500000 units", "05-06-2024 10:30", "in 2019 12 of 345 were 6789", "a+49 30 1234567", "0800-1700", "12 345 678 900", "v1.555.12.4567"]
    assert [(r["text"], r["n_phone"]) for r in masked(spark, texts)] == [(t, 0) for t in texts]
    d = masked(spark, ["+49 30 1234567 2024-01-01 and 555-123-4567 2024-01-01, +49 30 1234567 3.4.2024"])[0]
    assert (d["n_phone"], d["n_date"]) == (3, 3)


def test_cards_beside_other_numbers(spark):
    card, other = "4111111111111111", "5500005555555559"
    texts = [f"{card} 123", "4111 1111 1111 1111 12/26", f"5 {card}", f"{card} 2024-01-01", f"{card} 10.0.0.1", f"1234 {card} 5500 0055 5555 5559 77", f"{card} 123abc", "12 34 " * 40 + card, "12345 2024-01-01"]
    a, b, c, d, e, f, g, h, i = masked(spark, texts)
    new = masked(spark, [card])[0]["text"]
    parts = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}) 12/26", b["text"])
    assert a["text"] == f"{new} 123" and parts and parts[1].replace(" ", "") == new and c["text"] == f"5 {new}" and g["text"] == f"{new} 123abc"
    assert d["text"].startswith(f"{new} ") and (d["n_card"], d["n_date"]) == (1, 1) and (e["n_card"], e["n_ip"]) == (1, 1)
    assert f["n_card"] == 2 and f["text"].startswith(f"1234 {new} ") and f["text"].endswith(" 77") and f["text"][22:41].replace(" ", "") == masked(spark, [other])[0]["text"]
    assert h["n_card"] >= 1 and card not in h["text"] and i["n_date"] == 1
    assert [r["n_card"] for r in (a, b, c, g)] == [1] * 4


def test_long_rows_of_numbers(spark):
    text = " ".join(str(n % 97) for n in range(3000))
    assert len(masked(spark, [text, "7" * 5000])) == 2


def test_ways_of_writing_dates_are_bijections(spark):
    """All dates of some years, in every order and padding: pseudonyms are as many, are written the same way, and give the dates back."""
    texts = []
    for d in (date(1900, 1, 1) + timedelta(days=i) for y in (1904, 1977, 2024) for i in range((date(y, 1, 1) - date(1900, 1, 1)).days, (date(y + 1, 1, 1) - date(1900, 1, 1)).days)):
        ways = {f"{a}{sep}{b}{sep}{d.year}" for sep in "./" for x, y in ((d.day, d.month), (d.month, d.day)) for a in (f"{x}", f"{x:02d}") for b in (f"{y}", f"{y:02d}")}
        texts += sorted(ways)
    texts = sorted(set(texts))[:: 3] + [d.isoformat() for d in (date(1999, 12, 1) + timedelta(days=i) for i in range(100))] + ["4111 1111 1111 1111", "123-45-6789", "+1 (555) 123-4567", "10.0.0.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    made = pseudonyms.pseudonyms(df, "k")
    got = [r["text"] for r in made.orderBy("doc_id").collect()]
    assert len(set(got)) == len(texts) and all(re.sub(r"\d", "0", a) == re.sub(r"\d", "0", b) for a, b in zip(texts, got, strict=True) if "/" in a or "-" in a)
    back = pseudonyms.pseudonyms(made.select("doc_id", "text"), "k", undo=True).orderBy("doc_id").collect()
    assert [r["text"] for r in back] == texts and sum(a != b for a, b in zip(texts, got, strict=True)) > 0.99 * len(texts)


def test_pseudonyms_beside_columns_of_their_names(spark):
    df = spark.createDataFrame([(1, "on 2024-01-01", 7, "x"), (1, "on 2024-01-01", 7, "x"), (None, None, None, None)], "doc_id long, text string, n_ip long, pseudonyms_made string")
    got = pseudonyms.pseudonyms(df, "k")
    rows = got.orderBy("doc_id").collect()
    assert got.columns[:4] == df.columns and [(r["n_ip"], r["pseudonyms_made"], r["n_ip_"], r["n_date"]) for r in rows] == [(None, None, 0, 0), (7, "x", 0, 1), (7, "x", 0, 1)]
    assert pseudonyms.pseudonyms(df.limit(0), "k").collect() == []


def iban(rng, country, letters, n):
    body = letters + "".join(rng.choice("0123456789") for _ in range(n))
    number = lambda t: int("".join(str(int(c, 36)) for c in t))
    return f"{country}{98 - number(body + country + '00') % 97:02d}{body}"


def in_groups(text):
    return " ".join(text[i : i + 4] for i in range(0, len(text), 4))


def test_account_numbers_against_plain_feistel(spark):
    rng = random.Random(6)
    plain = [iban(rng, c, letters, n) for c, letters, n in (("DE", "", 18), ("GB", "WEST", 14), ("NL", "ABNA", 10), ("FR", "", 23), ("IT", "X", 22)) for _ in range(8)]
    got = masked(spark, [f"to {p}, or {in_groups(p)}." for p in plain])
    for p, r in zip(plain, got, strict=True):
        one, two = re.fullmatch(r"to (\S+), or (.+)\.", r["text"]).groups()
        digits = re.sub(r"\D", "", p[4:])
        u = len(digits) // 2
        x, y = feistel(int(digits[:u]), int(digits[u:]), 10**u, 10 ** (len(digits) - u), "k", "iban")
        new = iter(f"{x:0{u}d}{y:0{len(digits) - u}d}")
        body = "".join(next(new) if c.isdigit() else c for c in p[4:])
        number = int("".join(str(int(c, 36)) for c in body + p[:2] + "00"))
        assert one == f"{p[:2]}{98 - number % 97:02d}{body}" and two == in_groups(one) and r["n_iban"] == r["n_replaced"] == 2
    texts = ["DE00 1234 5678 9012 3456 78", "AB12 4111 1111 1111 1111", "DE89 3704"]
    a, b, c = masked(spark, texts)
    assert (a["n_iban"], a["text"], c["text"]) == (0, texts[0], texts[2]) and b["n_card"] == 1 and b["text"].startswith("AB12 ") and b["text"] != texts[1]


def test_dates_before_times_and_by_years(spark):
    a, b, c, d = masked(spark, ["at 2024-02-29T10:00:00Z and 2024-02-29", "2024/03/05 or 2024/3/5", "http://x.org/2024/03/05/a 2024/13/05", "2024-02-29Tx"])
    one, two = re.fullmatch(r"at (\S+)T10:00:00Z and (\S+)", a["text"]).groups()
    assert one == two != "2024-02-29" and a["n_date"] == 2
    x, y = b["text"].split(" or ")
    assert re.fullmatch(r"\d{4}/\d\d/\d\d", x) and re.fullmatch(r"\d{4}/\d/\d", y) and b["n_date"] == 2 and b["text"] != "2024/03/05 or 2024/3/5"
    assert (c["text"], d["text"]) == ("http://x.org/2024/03/05/a 2024/13/05", "2024-02-29Tx")


def test_every_kind_comes_back(spark):
    """Texts of all kinds and layouts: what they are replaced by is read the same way, and ``undo`` gives them back."""
    rng = random.Random(13)
    digits = lambda shape: re.sub("0", lambda m: rng.choice("0123456789"), shape)
    texts = []
    for _ in range(120):
        shape = rng.choice(PHONES)
        keep = re.match(r"\+\d{1,3}(?: \(0\))?|00\d\d|\(?0[1-9]|1-", shape)
        head = keep[0] if keep else ""
        texts.append(head + digits(re.sub(r"\d", "0", shape[len(head) :])))
    for _ in range(40):
        day = date(1900, 1, 1) + timedelta(days=rng.randrange(73049))
        texts += [f"{day.isoformat()}T0{rng.randrange(10)}:00", f"{day:%Y/%m/%d}", f"{day.year}/{day.month}/{day.day}", f"{day:%d.%m.%Y}", f"{day.month}/{day.day}/{day.year}"]
        texts += [in_groups(iban(rng, "DE", "", 18)), f"{rng.randrange(1, 666):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}", ".".join(str(rng.randrange(256)) for _ in range(4))]
        body = digits("0" * 15)
        texts.append(body + next(c for c in "0123456789" if luhn(body + c)))
    df = spark.createDataFrame([(i, f"see {t}, then") for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    made = pseudonyms.pseudonyms(df, "k").orderBy("doc_id").collect()
    changed = sum(r["text"] != f"see {t}, then" for t, r in zip(texts, made, strict=True))
    assert changed >= 0.99 * len(texts) and all(re.sub(r"\d", "0", r["text"]) == re.sub(r"\d", "0", f"see {t}, then") for t, r in zip(texts, made, strict=True) if t.count(".") != 3)
    back = pseudonyms.pseudonyms(spark.createDataFrame([(r["doc_id"], r["text"]) for r in made], "doc_id long, text string"), "k", undo=True).orderBy("doc_id").collect()
    wrong = [(t, r["text"], b["text"]) for t, r, b in zip(texts, made, back, strict=True) if b["text"] != f"see {t}, then"]
    assert not wrong, wrong[:5]


def test_dates_are_a_bijection(spark):
    days = [date(1900, 1, 1) + timedelta(days=31 * i) for i in range(2300)]
    got = masked(spark, [d.isoformat() for d in days])
    assert len({r["text"] for r in got}) == len(days) and all(1900 <= int(r["text"][:4]) <= 2099 for r in got)


D = [date(2024, 1, 1) + timedelta(days=i) for i in range(10)]


def looked_up(spark, urls, entries):
    caps = spark.createDataFrame(urls, "page_id long, url string, fetched date").withColumn("pattern", F.lit("clash"))
    listed = spark.createDataFrame(entries, "list string, pattern string, action string, date date")
    return {(r["page_id"], r["fetched"]): r for r in url_filter(caps, listed).collect()}


def test_url_intervals(spark):
    entries = [("l", "bad.com", "add", D[2]), ("l", "bad.com", "add", D[3]), ("l", "bad.com", "remove", D[5]), ("l", "bad.com", "add", D[7]), ("m", "www.bad.com/x", "add", D[0]), ("l", "off.org", "add", D[1]), ("l", "off.org", "remove", D[1]), ("l", None, "add", D[1]), ("l", "n.org", None, D[1])]
    urls = [(i, "https://u@WWW.bad.com:80/x/y?q", D[i]) for i in range(10)] + [(20, "http://notbad.com/", D[3]), (21, None, D[3]), (22, "nonsense", D[3]), (23, "http://off.org", D[4]), (24, "http://bad.com", None), (25, "http://bad.com./", D[4])]
    got = looked_up(spark, urls, entries)
    assert [got[i, D[i]]["n_active"] for i in range(10)] == [1, 1, 2, 2, 2, 1, 1, 2, 2, 2]
    assert got[4, D[4]]["pattern"] == "www.bad.com/x" and not any(got[i, D[3]]["blocked"] for i in (20, 21, 22)) and not got[23, D[4]]["blocked"] and not got[24, None]["blocked"]
    assert got[25, D[4]]["since"] == D[2]


def test_url_hosts_in_any_case_paths_in_their_own_and_addresses(spark):
    entries = [("l", "BAD.com/Docs", "add", D[0]), ("l", "0.0.1", "add", D[0]), ("l", "0.1", "add", D[0]), ("l", "10.0.0.2/a", "add", D[0]), ("l", "[2001:DB8::1]", "add", D[0]), ("l", "1.example.org", "add", D[0])]
    urls = ["http://bad.COM/Docs/x", "http://bad.com/docs/x", "http://10.0.0.1/", "http://10.0.0.2:80/a", "http://[2001:db8::1]:8080/x", "http://u@[2001:db8::2]/", "http://10.0.0.1.example.org/"]
    got = looked_up(spark, [(i, u, D[1]) for i, u in enumerate(urls)], entries)
    assert [got[i, D[1]]["pattern"] for i in range(7)] == ["bad.com/Docs", None, None, "10.0.0.2/a", "[2001:db8::1]", None, "1.example.org"]
    assert [got[i, D[1]]["host"] for i in (4, 5)] == ["[2001:db8::1]", "[2001:db8::2]"]


def test_url_odd_tables(spark):
    urls = [(1, "http://a.b.com/", D[1])] * 3
    assert len(looked_up(spark, urls, [])) == 1
    caps = spark.createDataFrame(urls, "page_id long, url string, fetched date")
    listed = spark.createDataFrame([("l", "b.com", "add", D[0])], "list string, pattern string, action string, date date")
    assert [r["n_active"] for r in url_filter(caps, listed).collect()] == [1, 1, 1] and url_filter(caps.limit(0), listed).collect() == []


def test_url_lists_as_tables(spark, monkeypatch):
    """Beyond the broadcast limit, with a hot domain: the same rows."""
    from tidemark.llm import common

    urls = [(i, f"http://h{i % 7}.hot.com/a/b{i % 5}", D[i % 10]) for i in range(120)] + [(200 + i, f"http://x{i}.org/", D[3]) for i in range(30)]
    entries = [("l", "hot.com", "add", D[2]), ("l", "hot.com", "remove", D[6]), ("m", "h3.hot.com/a", "add", D[4]), ("m", "hot.com", "add", D[0])] + [("n", f"x{i}.org", "add", D[1]) for i in range(0, 30, 3)]
    local = looked_up(spark, urls, entries)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common.small_enough, "__defaults__", (16, 0))
    monkeypatch.setattr(common, "KEY_ROWS", 9)
    assert looked_up(spark, urls, entries) == local and any(r["n_active"] == 3 for r in local.values())


SIDE = "<div class='sidebar'><p>Side, bar, text of it, about other things, here and there.</p></div>"
REPLIES = "<div id=comments><p>Nice, article, thanks, a lot, really great to read, I say.</p></div>"
BAR = "<div class='cookie-notice'>We use cookies, as all do, and so on, for very long.</div>"


@pytest.mark.parametrize("inner", ["{}", "<div class=main>{}</div>", "<div><div>{}</div></div>"])
@pytest.mark.parametrize("box", ['<div class="content-sidebar-wrap">', '<div id="page" class="right-sidebar">', '<form id="aspnetForm">', '<div class="post comments-open">', '<div class="content login-required">', '<div class="popup-history entry">', "<section class='layout_no-pagination_x nav-collapsed'>"])
def test_wrappers_with_names_of_other_parts(box, inner):
    end = f"</{re.match('<([a-z]+)', box)[1]}>"
    text = "<h1>Title of it</h1>" + "".join(f"<p>{p}</p>" for p in article(8))
    want = "Title of it " + " ".join(article(8))
    assert extract(f"<html><body>{box}{inner.format(text)}{SIDE}{REPLIES}{BAR}{end}</body></html>") == want
    assert extract(f"<html><body>{box}{inner.format(text)}{end}{SIDE}{REPLIES}{BAR}</body></html>") == want
    assert extract(f"<html><body>{inner.format(text)}{BAR}<form><p>{PARA}</p><input></form>{SIDE}</body></html>") == want


def test_long_comments_are_no_article_and_short_articles_are():
    text = "".join(f"<p>{p}</p>" for p in article(2))
    replies = "".join(f"<p>{PARA.format(i)} And more, I think, of my own, as a reply.</p>" for i in range(30))
    for name in ("comments", "comment-list", "disqus-comments", "newsletter-popup"):
        assert extract(f"<body><div class=story>{text}</div><div class='{name}'>{replies}</div></body>") == " ".join(article(2))
    assert extract("<body><div class='ad'>Buy, now, what is, very, cheap, today.</div><article><h1>Short.</h1><p>Short.</p></article></body>") == "Short. Short."
    assert extract(f"<body><div class='sidebar'>{text * 4}</div></body>") == " ".join(article(2) * 4)


def test_what_leads_into_an_article_stays_and_ties_go_to_the_first():
    body = "".join(f"<p>{p}</p>" for p in article(4))
    assert extract(f"<body><div><h1>Head</h1><p>Short lede.</p><div class=text>{body}</div><p>Next.</p></div></body>") == "Head Short lede. " + " ".join(article(4))
    one, two = (f"<div><div><div><p>{w} {PARA}</p></div></div></div>" for w in ("One", "Two"))
    assert extract(f"<body><div>{one}</div><table><tr><td></td></tr></table><div>{two}</div></body>").startswith("One")


#: Pages as layouts in the wild have them, with the article's words marked by what they begin with: a stands for the article, z for the rest.
_LAYOUTS = [
    "<div id='wrapper' class='two-sidebars'><div id='masthead-wrap'><h2>{z6}</h2></div><div id='primary' class='content-area'><main>{a}</main></div><div id='secondary' class='widget-area'><ul><li>{z20}</li></ul></div></div>",
    "<form method='post' action='./Default.aspx' id='aspnetForm'><div class='s4-workspace'><div class='ms-rtestate-field'>{a}</div></div><div class='footer'>{z9}</div></form>",
    "<div class='site has-sidebar-right sidebar-sticky'><div class='entry-wrap'><h1>{a5}</h1><div class='entry-meta-comments-2'></div>{a}</div><section class='comments'><p>{z30}</p><p>{z30}</p></section></div>",
    "<table class='layout nav-left'><tr><td class='nav'>{z12}</td><td class='text'>{a}</td><td class='ads'>{z15}</td></tr></table>",
    "<div class='paywall subscription-content article-body'>{a}</div><div class='newsletter-signup'><p>{z25}</p></div>",
    "<div class='t-post comment-enabled'>{a}<div class='comment-respond'><form><p>{z14}</p></form></div></div>",
    "<div id='content' class='widget-less'><h1>{a4}</h1><p>{a3}</p><div class='body'>{a}</div></div><div class='cookie-consent-banner'>{z22}</div>",
]


def test_precision_and_recall_on_layouts_of_other_names():
    rng = random.Random(21)
    words = lambda kind, n: " ".join(f"{kind}{rng.randrange(10**6):x}{rng.choice(['', '', '', ','])}" for _ in range(n))
    found = hit = want = 0
    for _ in range(25):
        for layout in _LAYOUTS:
            body = "".join(f"<p>{words('a', rng.randrange(12, 70))}</p>" for _ in range(rng.randrange(2, 9)))
            made = re.sub(r"\{([az])(\d*)\}", lambda m: words(m[1], int(m[2])) if m[2] else body, layout)
            got = extract(f"<html><body>{made}</body></html>").split()
            truth = re.findall(r"\ba[0-9a-f]+\b", re.sub(r"<[^>]*>", " ", made))
            found, hit, want = found + len(got), hit + sum(w.startswith("a") for w in got), want + len(truth)
    assert hit >= 0.97 * found and hit >= 0.97 * want
