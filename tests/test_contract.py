from __future__ import annotations

import copy

import pytest

from tablegate.contract import ContractError, load

DOCUMENT = {
    "contract": {"name": "t", "version": "v1"},
    "columns": [
        {"name": "amount", "type": "decimal", "nullable": False},
        {"name": "at", "type": "timestamp"},
        {"name": "_written_at", "type": "timestamp"},
    ],
    "quality_rules": [
        {"id": "negative", "policy": "drop", "condition": "amount < 0"},
        {"id": "large", "policy": "flag", "condition": "amount > 10"},
        {"id": "old", "policy": "keep", "condition": "at < '2020-01-01'"},
        {"id": "duplicates", "policy": "resolved_upstream"},
    ],
}


def changed(**paths):
    document = copy.deepcopy(DOCUMENT)
    for section, (index, key, value) in paths.items():
        target = document[section] if index is None else document[section][index]
        if value is None:
            target.pop(key, None)
        else:
            target[key] = value
    return document


def test_roles_of_columns_and_rules():
    contract = load(DOCUMENT)
    assert [c.name for c in contract.business_columns] == ["amount", "at"]
    assert [c.name for c in contract.audit_columns] == ["_written_at"]
    assert [r.id for r in contract.counted_rules] == ["negative", "large", "old"]
    assert [r.id for r in contract.drop_rules] == ["negative"]
    assert [r.id for r in contract.flag_rules] == ["large"]


def test_not_null_rules_follow_declared_nullability():
    rules = load(DOCUMENT).enforcing_not_null().drop_rules
    assert [(r.id, r.condition) for r in rules[1:]] == [("not_null_amount", "`amount` IS NULL")]


def test_contract_file_of_the_package_loads():
    from tablegate.suite.fixtures import trips_contract

    contract = trips_contract()
    assert len(contract.columns) == 6 and len(contract.rules) == 5 and len(contract.drop_rules) == 4


@pytest.mark.parametrize(
    "document, message",
    [
        (changed(contract=(None, "version", None)), "version"),
        (changed(columns=(0, "type", None)), "type"),
        (changed(columns=(0, "type", "money")), "unknown type 'money'"),
        (changed(columns=(1, "name", "amount")), "more than once"),
        (changed(quality_rules=(1, "id", "negative")), "more than once"),
        (changed(quality_rules=(0, "id", None)), "id"),
        (changed(quality_rules=(0, "condition", None)), "condition"),
        (changed(quality_rules=(0, "policy", "ignore")), "unknown policy 'ignore'"),
        ({"columns": []}, "contract"),
    ],
)
def test_unusable_documents_are_rejected(document, message):
    with pytest.raises(ContractError, match=message):
        load(document)
