"""Personal data in texts with very many matches."""

import hashlib
import time

from spanloom.llm import pii


def test_very_many_matches_in_one_text(spark):
    """100,000 addresses in one text, and 50,000 mail addresses beside as many candidates in another: right places, in linear time."""
    n = 100_000
    ips = [f"10.{i % 256}.{i // 256 % 256}.7" for i in range(n)]
    mails = [f"a{i}@x.org" for i in range(n // 2)]
    mixed = " ".join(f"{m} 555-123-{i % 10000:04d}" for i, m in enumerate(mails))
    docs = spark.createDataFrame([(1, " ".join(ips)), (2, mixed)], "doc_id long, text string").repartition(2)
    began = time.monotonic()
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert time.monotonic() - began < 60

    def digest(text, spans, kind):
        at, out = 0, []
        for s in spans:
            at = text.index(s, at)
            out.append(f"{kind}:{at}:{at + len(s)}")
            at += len(s)
        return hashlib.sha256(",".join(out).encode()).hexdigest()

    assert (got[1].n_ip, got[2].n_email) == (n, n // 2)
    assert got[1].base_sha256 == digest(" ".join(ips), ips, "ip")
    assert got[2].base_sha256 == digest(mixed, mails, "email")
