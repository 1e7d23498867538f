import random
import re

from samples import awkward, table

from tidemark.llm.secret_scan import KINDS, crc_tail, scan_secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def test_base_kinds_against_brute_force(spark):
    r = random.Random(7)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "ToKen", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "é", "ß中", "\n"]
    parts += ["AKIA", "akia", "ABCDEF0123456789", "0123456789abcdef", "deadbeefdeadbeefdeadbeefdeadbeef", "x", "12345678", "a/b+c=_.-", "AKIAAKIA"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for i in range(1500)] + awkward()
    got = scan_secrets(table(spark, rows)).collect()
    assert sorted((str(g["doc_id"]), [(s["start"], s["end"], s["kind"]) for s in g["spans"]]) for g in got) == sorted((str(i), brute(t)) for i, t in rows)


def test_checksums(spark):
    body = "abcDEF0123456789abcDEF01234567"
    good = "ghp_" + body + crc_tail(body.encode()).decode()
    rows = [
        (1, f"é {good} and"), (2, good[:-1] + ("A" if good[-1] != "A" else "B")), (3, "card no. 4111 1111 1111 1111."), (4, "card 4111 1111 1111 1112"),
        (5, "iban: DE89 3704 0044 0532 0130 00 The end"), (6, "IBAN GB82WEST12345698765432"), (7, "iban DE88 3704 0044 0532 0130 00"),
    ]
    found = {g["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in g["spans"]] for g in scan_secrets(table(spark, rows)).collect()}
    assert found[1] == [("github", 2, 2 + len(good))] and found[2] == [] and found[4] == [] and found[7] == []
    assert [k[0] for k in found[3]] == ["card"] and rows[2][1][found[3][0][1] : found[3][0][2]] == "4111 1111 1111 1111"
    assert rows[4][1][found[5][0][1] : found[5][0][2]] == "DE89 3704 0044 0532 0130 00" and [k[0] for k in found[6]] == ["iban"]


def test_empty(spark):
    assert scan_secrets(table(spark, [(1, "a")]).where("false")).collect() == []
