"""Operator 10: licence bodies of several paragraphs inside longer documents."""
from tidewater.llm import license_scan

MIT = [t.text for t in license_scan.TEMPLATES if t.license_id == "MIT"][2]


def test_op10_a_body_of_several_paragraphs_in_a_document(spark):
    cuts = [MIT.index("The above"), MIT.index("THE SOFTWARE IS")]
    parts = [MIT[: cuts[0]], MIT[cuts[0] : cuts[1]], MIT[cuts[1] :]]
    rest = "\n\n".join(f"Part {i} tells of other things that have nothing to do with rights at all." for i in range(40))
    agpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
    bsd = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."  # noqa: E501
    docs = spark.createDataFrame([(1, rest + "\n\n" + "\n\n".join(parts) + "\n\n" + rest), (2, f"x\n{agpl}\ny"), (3, f"x\n{bsd}\ny")],
                                 "doc_id long, text string")
    rows = license_scan.scan(docs).collect()
    assert {r["unit_no"] for r in rows if r["doc_id"] == 1 and r["license_id"] == "MIT"} == {80, 82, 84}
    assert {r["license_id"] for r in rows if r["doc_id"] == 2 and r["dice"] == 1} == {"AGPL-3.0"}
    assert {r["license_id"] for r in rows if r["doc_id"] == 3} == {"BSD-3-Clause"}
