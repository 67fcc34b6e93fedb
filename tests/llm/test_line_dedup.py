import hashlib

from helpers import collected, documents, odd_rows

from commitloom.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def slow(rows, min_documents=2):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    held = {}
    for d, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(2**63 - 1 if d is None else d)
    out = []
    for d, text, *_ in rows:
        lines = (text or "").split("\n")
        owner = 2**63 - 1 if d is None else d
        kept = [x for x in lines if len(held.get(key(x), ())) < min_documents or min(held[key(x)]) == owner]
        out.append((str(d), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def found(df, **options):
    rows = collected(line_dedup.drop_shared_lines(df, **options))
    return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in rows)


def test_against_brute_force(llm):
    shared = "A Line That Many Share"
    rows = [
        *odd_rows(),
        (10, f"own line number one\n{shared}\n\n  {shared.upper()} \t\nshort"),
        (11, f"{shared}\nshort\nÉtude Number Ten"),
        (12, f"étude number ten\nÉTUDE NUMBER TEN\nÉtude Number TEN\n{shared.lower()}\n"),
        (13, "\n".join(f"line number {i}" for i in range(3000))),
        (14, "\n".join(f"LINE number {i} " for i in range(0, 3000, 2)) + "\n"),
        (15, "\n\n\n"),
    ]
    assert found(documents(llm, rows)) == slow(rows)
    assert found(documents(llm, rows), min_documents=3) == slow(rows, 3)
    assert found(documents(llm, rows).limit(0)) == []


def test_query_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
