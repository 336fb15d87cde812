"""Operator 3: an account number ends at its own length."""
from tidewater.llm import private_spans


def test_op3_iban_before_other_words(spark):
    compact, grouped, german = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"
    texts = {1: (f"{compact} BIC COBADEFFXXX", [compact]), 2: (f"{compact} I will pay 100", [compact]),
             3: (f"{grouped} {german}", [grouped, german]), 4: (f"AB12 {german} EUR 7", [german]), 5: (f"{compact}7", []),
             6: ("GB82 WEST 1234 5698 7654 33 X", [])}
    docs = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id long, text string")
    for r in private_spans.find_private(docs).collect():
        text, want = texts[r["doc_id"]]
        assert [text[s["start"] : s["end"]] for s in r["found"] if s["kind"] == "iban"] == want, text
