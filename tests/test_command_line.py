"""The subcommands on the smallest tables; training and scoring are tested with the models."""

import pytest

from quayside import __main__ as cli
from quayside.plans import registry


def test_stages(spark, sf_dir, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "clear_staged", lambda session: None)  # other tests share the session and its tables
    raw, processed = registry.written_csvs(spark, sf_dir), str(tmp_path)
    cli.main(["audit", raw])
    assert "carrier_type" in capsys.readouterr().out

    cli.main(["etl", raw, processed])
    assert "rolling_3m_avg_delay" in capsys.readouterr().out

    cli.main(["dashboard", processed, "--years", "1996", "--compare", "Supplier#000000003", "Supplier#000000007"])
    out = capsys.readouterr().out
    assert "carrier_compare" in out and "/shipment" in out


def test_arguments():
    args = cli.parser().parse_args(["whatif", "p", "m", "C1", "C2", "--swap", "id"])
    assert (args.run, args.carrier_from, args.carrier_to, args.sample, args.swap) == (cli.whatif, "C1", "C2", 50, "id")
    assert cli.parser().parse_args(["train", "p", "m"]).run is cli.train
    with pytest.raises(SystemExit):
        cli.parser().parse_args([])
