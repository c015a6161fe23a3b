import datetime as dt
import ipaddress
import random

from airnet.llm.pii import Feistel, Pseudonyms, iban_check, luhn, pseudonymise

KEY = b"test key"


def test_feistel_is_a_permutation():
    f = Feistel(KEY, "x")
    assert len({f.apply(f"{i:03d}") for i in range(1000)}) == 1000
    for s in ("7", "12", "0000", "12345678901234567"):
        assert f.invert(f.apply(s)) == s and len(f.apply(s)) == len(s)


def test_formats_and_links():
    p = Pseudonyms(KEY)
    payload = "".join(random.Random(1).choices("0123456789", k=15))
    card = payload + luhn(payload)
    spaced = " ".join(card[i:i + 4] for i in range(0, 16, 4))
    a, b = p.of("card", card), p.of("card", spaced)
    assert a != card and luhn(a[:-1]) == a[-1] and b.replace(" ", "") == a and [len(x) for x in b.split(" ")] == [4] * 4
    assert p.of("card", payload + str((int(luhn(payload)) + 1) % 10)) is None
    iban = "DE" + iban_check("DE", "370400440532013000") + "370400440532013000"
    new = p.of("iban", iban)
    assert new != iban and iban_check("DE", new[4:]) == new[2:4]
    assert p.of("date", "2024-02-30") is None and p.of("date", "2024-02-29") != "2024-02-29"
    assert p.of("date", "29.02.2024") == ".".join(reversed(p.of("date", "2024-02-29").split("-")))


def test_documents(spark):
    text = "Mail jane.doe@example.org, call +49 30 1234567, born 1980-05-17, ip 10.0.0.1."
    df = spark.createDataFrame([(1, text), (2, "again 1980-05-17"), (3, None), (None, ""), (4, "no data, version 2.0")],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in pseudonymise(df, KEY).collect()}
    assert {s.kind for s in got[1].spans} == {"email", "phone", "date", "ip"} and "1980-05-17" not in got[1].text
    date = next(s.pseudonym for s in got[1].spans if s.kind == "date")
    assert got[2].text == f"again {date}" and got[3].text is None and got[4].text == "no data, version 2.0"
    assert pseudonymise(df.limit(0), KEY).count() == 0


def test_values_beside_other_digits():
    """A match that takes in what follows the value does not leave the value in clear."""
    p = Pseudonyms(KEY)

    def found(text):
        return [(s["kind"], text[s["start"]:s["end"]]) for s in p.replace(text)[1]]

    card = "4111 1111 1111 1111"
    for after in (" 12/27", " 123", " 1", ", 12"):
        assert found(card + after)[0] == ("card", card)
    assert found(f"1234 {card}") == [("card", card)]
    assert found("+1 415 555 0100 2024-05-05") == [("phone", "+1 415 555 0100"), ("date", "2024-05-05")]
    assert found("030 1234567 030 7654321") == [("phone", "030 1234567"), ("phone", "030 7654321")]
    assert found("+33 1 23 45 06 07 030 7654321") == [("phone", "+33 1 23 45 06 07"), ("phone", "030 7654321")]
    assert found("+1 415 555 0100 12345678") == [("phone", "+1 415 555 0100")]
    assert found("DE89 3704 0044 0532 0130 00 12") == [("iban", "DE89 3704 0044 0532 0130 00")]
    for iban in ("GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606", "NL91 ABNA 0417 1643 00"):
        assert found(f"{iban} AND MORE") == [("iban", iban)]
        new = p.of("iban", iban).replace(" ", "")
        assert iban_check(new[:2], new[4:]) == new[2:4] and p.of("iban", iban.replace(" ", "")) == new != iban.replace(" ", "")
        assert [c.isalpha() for c in new] == [c.isalpha() for c in iban.replace(" ", "")]
    assert p.of("date", "05/17/1980") != "05/17/1980"
    assert found("05/17/1980") == [("date", "05/17/1980")] and found("13/17/1980") == []
    assert found("XY12 NO ACCOUNT HERE AT ALL 12") == []


def test_no_value_is_its_own_pseudonym():
    """Every string of a small format, every day of an era: a permutation without fixed points."""
    for alphabet, n in (("ab", 1), ("0123456789", 1), ("0123456789", 3), ("abc", 4)):
        f, size = Feistel(KEY, "x", alphabet), len(alphabet) ** n
        every = ["".join(alphabet[i // len(alphabet) ** k % len(alphabet)] for k in range(n)) for i in range(size)]
        images = [f.apply(s) for s in every]
        assert sorted(images) == sorted(every) and all(a != b for a, b in zip(every, images))
        assert [f.invert(s) for s in images] == every
    p = Pseudonyms(KEY)
    days = [dt.date.fromordinal(i).isoformat() for i in range(dt.date(1000, 1, 1).toordinal(), dt.date(1100, 1, 1).toordinal())]
    images = [p.of("date", d) for d in days]
    assert sorted(images) == days and all(a != b for a, b in zip(days, images))


def test_values_in_any_script_and_form():
    p = Pseudonyms(KEY)

    def new(text):
        out, spans = p.replace(text)
        assert len(spans) == 1 and (spans[0]["start"], spans[0]["end"]) == (0, len(text)), (text, spans)
        return out

    for mail in ("jürgen@x.de", "jane@janedoe.name", "иван.петров@почта.рф", "山田@example.co.jp", "a@b.io"):
        got = new(mail)
        assert [c if not c.isalnum() else "x" for c in got] == [c if not c.isalnum() else "x" for c in mail]
        name, domain = mail.split("@")
        assert name not in got.split("@")[0] and all(x not in got.split("@")[1].split(".")[:-1] for x in domain.split(".")[:-1])
    assert new("Jane@JaneDoe.name") == new("jane@janedoe.name")
    assert new("17.05.1899") != "17.05.1899" and 1700 <= int(new("17.05.1899")[-4:]) < 1900
    assert [int(x) for x in new("1.2.1980").split(".")] == [int(x) for x in new("01.02.1980").split(".")]
    assert new("1/2/1980").replace("/", ".") == new("1.2.1980") and new("2024/5/3").count("/") == 2
    assert new("2001:db8::1") == new("2001:0DB8:0:0:0:0:0:1") and ipaddress.IPv6Address(new("fe80::1:2"))
    for clean in ("at 12:30:45 sharp", "std::vector<int> ::add", "00:1a:2b:3c:4d:5e", "a @ b.org", "..@x.org", "6.1.7601"):
        assert p.replace(clean) == (clean, [])


def test_against_planted_values():
    """Values made without the library stand at random places of clean words: all are found, and nothing else."""
    rng = random.Random(5)

    def card():
        d = [4] + [rng.randrange(10) for _ in range(14)]
        total = sum(x if i % 2 else sum(divmod(2 * x, 10)) for i, x in enumerate(d))
        return "".join(map(str, d)) + str(-total % 10)

    def iban():
        account = "".join(rng.choices("0123456789", k=18))
        return f"DE{98 - int(account + '131400') % 97:02d}{account}"

    makers = {
        "card": card, "iban": iban,
        "date": lambda: dt.date(rng.randint(1700, 2200), rng.randint(1, 12), rng.randint(1, 28)).strftime(rng.choice(["%d.%m.%Y", "%d/%m/%Y", "%Y-%m-%d"])),
        "ssn": lambda: f"{rng.randint(100, 600):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}",
        "ip": lambda: ".".join(str(rng.randint(1, 254)) for _ in range(4)),
        "ipv6": lambda: ":".join(f"{rng.randint(1, 0xffff):x}" for _ in range(8)),
        "phone": lambda: f"+49 {rng.randint(30, 99)} {rng.randint(1000000, 9999999)}",
        "email": lambda: "".join(rng.choices("abcöд", k=rng.randint(1, 9))) + "@" + "".join(rng.choices("xyzé", k=3)) + ".org"}
    words, p, known = "the of river, node walks (and) 7 tall: 42 trees; x-ray a/b".split(), Pseudonyms(KEY), {}
    for _ in range(400):
        text, want = "", []
        for _ in range(rng.randint(0, 6)):
            text += " ".join(rng.choices([w for w in words if not w.isdigit()], k=rng.randint(1, 8))) + " "
            kind = rng.choice(list(makers))
            value = makers[kind]()
            want.append((kind, len(text), len(text) + len(value)))
            text += value + rng.choice([" ", ", ", ". ", "; "]) + "and "
        out, spans = p.replace(text)
        assert [(s["kind"], s["start"], s["end"]) for s in spans] == want, text
        rest, at = "", 0
        for s in spans:
            value = text[s["start"]:s["end"]]
            assert s["pseudonym"] != value and known.setdefault((s["kind"], value), s["pseudonym"]) == s["pseudonym"]
            rest += text[at:s["start"]] + s["pseudonym"]
            at = s["end"]
        assert out == rest + text[at:]


def test_odd_rows(spark):
    """Repeated rows, NULL ids, a clashing column and a very long text."""
    long = "a.b-" * 100_000 + " card 4111111111111111 " + "1 " * 50_000
    df = spark.createDataFrame([(1, "x@y.org", "k"), (1, "x@y.org", "k"), (None, "x@y.org", None), (2, long, "")],
                               "doc_id long, text string, spans string")
    got = pseudonymise(df, KEY).collect()
    assert len(got) == 4 and len({r.text for r in got if r.doc_id != 2}) == 1
    assert [s.kind for r in got if r.doc_id == 2 for s in r.spans] == ["card"]
