from __future__ import annotations

import json

from panel_helpers import sample_rows

from weekcast.__main__ import main


def test_run_from_landed_files(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    records = [
        {"week_start": str(r[1]), "epiweek": 202301 + i, "num_ili": r[3], "num_patients": r[4], "ili": r[5]}
        for i, r in enumerate(sample_rows())
    ]
    payload = json.dumps({"result": 1, "epidata": records})
    line = {"series": "ca", "fetched_at": "2024-05-01T00:00:00Z", "payload": payload}
    (tmp_path / "landing" / "a.json").write_text(json.dumps(line))
    options = ["--landing", str(tmp_path / "landing"), "--ledger", str(tmp_path / "ledger"), "--out", str(tmp_path / "out")]
    options += ["--as-of", "2024-05-01T16:00:00Z", "--trees", "2"]
    assert main([*options, "--region", "California", "--per-series-files"]) == 0
    (file,) = (tmp_path / "out" / "summary" / "series=ca").glob("*.txt")
    assert "  Week Starting: 2024-05-06\n  Predicted ILI: 1696\n  95% PI: [922, 2828]\n" in file.read_text()
    assert main([*options, "--region", "Atlantis"]) == 1
    assert main([*options, "--region", "Texas"]) == 1
    refused = {"series": "ca", "fetched_at": "2024-05-08T00:00:00Z", "payload": json.dumps({"result": -1, "message": "closed"})}
    (tmp_path / "landing" / "b.json").write_text(json.dumps(refused))
    assert main([*options, "--region", "California"]) == 1
    (row,) = spark.read.parquet(str(tmp_path / "out" / "errors")).collect()
    assert tuple(row) == ("ca", "closed")
