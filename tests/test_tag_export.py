"""The export of tags with more keys than fit into columns."""

import pytest

from siltbed.sources import sinks


def test_many_tag_keys(spark):
    rows = [(i, f"r{i}", {f"k{i}": "=1" if i == 7 else str(i), "name": "x"}) for i in range(1200)]
    elements = spark.createDataFrame(rows, "n long, result_id string, tags map<string,string>")
    with pytest.raises(ValueError, match="tag_rows"):
        sinks.tag_columns(elements, "n")
    some = elements.where("n < 999")
    assert len(sinks.tag_columns(some, "n")) == 1000
    found = {(r["result_id"], r["key"]) for r in sinks.tag_rows(elements).collect()}
    assert found == {(r, k) for _, r, tags in rows for k in tags}
