from tidemark.llm import secret_ledger as L

DDL = "path string, version long, text string"


def test_findings_of_a_history_go_to_all_paths_and_only_new_blobs_are_scanned(spark, tmp_path, monkeypatch):
    ledger, scanned, scan = f"file://{tmp_path}/ledger", [], L.scan

    def counted(*args):
        scanned.append(scan(*args))
        return scanned[-1]

    monkeypatch.setattr(L, "scan", counted)
    secret, key = "x password: hunter22 y", "AKIA" + "Q" * 16
    first = [("a", 1, secret), ("a", 2, "clean"), ("b", 1, secret), ("b", 1, secret), ("c", 1, None)]
    found = lambda rows, rules=L.RULES: sorted((r.path, r.version, r.kind, r.start, r.end) for r in L.history_findings(spark.createDataFrame(rows, DDL), ledger, rules).collect())
    assert found(first) == [("a", 1, "assign", 2, 20), ("b", 1, "assign", 2, 20)] and scanned == [9]  # three blobs, three rules
    # A secret that a later version removes stays in the history; a path that is moved costs no scan.
    more = [*first, ("d", 1, secret), ("a", 3, key)]
    assert found(more) == [("a", 1, "assign", 2, 20), ("a", 3, "access", 0, 20), ("b", 1, "assign", 2, 20), ("d", 1, "assign", 2, 20)] and scanned[1:] == [3]
    # A new version of one rule looks at all four blobs with this rule alone.
    longer = (*L.RULES[:1], L.Rule("access", "2", r"AKIA[A-Z0-9]+", 0, 30), *L.RULES[2:])
    assert [r for r in found(more, longer) if r[2] == "access"] == [] and scanned[2:] == [4]
    assert found([]) == [] and scanned[3:] == [0]
