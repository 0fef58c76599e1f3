import pytest

from millrace.__main__ import main
from millrace.plans.refine import Layers
from tests.lms_rows import csv_text, row


@pytest.mark.parametrize("how", ["ingest", "stream"])
def test_commands(spark, tmp_path, how):
    drops, tables = tmp_path / "drops", str(tmp_path / "tables")
    drops.mkdir()
    (drops / "one.csv").write_text(csv_text(row("1")))
    (drops / "two.csv").write_text(csv_text(row("2"), row("3")))
    main([how, str(drops), tables, "2024-01-15", "--min-rows", "2"], spark)
    main(["refresh", tables], spark)
    rows = Layers(spark, tables).fact.read().collect()
    assert sorted(r.Student_ID for r in rows) == ["2", "3"]


def test_mistakes_are_errors(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["unknown"], spark)
    with pytest.raises(ValueError):
        main(["ingest", str(tmp_path), str(tmp_path / "t"), "15.1.2024"], spark)
    with pytest.raises(Exception, match="(?i)not.exist"):
        main(["ingest", str(tmp_path / "absent"), str(tmp_path / "t"), "2024-01-15"], spark)
