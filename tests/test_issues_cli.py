"""The issues command lists and settles what keeps a refresh from running."""
from railpulse.__main__ import main
from railpulse.streaming.ledger import Issue, Ledger


def test_issues_are_listed_and_dismissed(spark, tmp):
    Ledger(spark, f"{tmp}/delays").settle([Issue("week x", "f.csv", "holds no rows")], set(), "1")
    args = ["issues", "--delays", f"{tmp}/delays", "--weather", f"{tmp}/weather"]
    assert main(args) == {"delays": {"week x": "holds no rows"}, "weather": {}}
    assert main([*args, "--dismiss", "week x", "--reason", "withdrawn"]) == {"delays": {}, "weather": {}}
    assert main(args) == {"delays": {}, "weather": {}}
