import pytest

from maskline import catalog as C


@pytest.mark.parametrize(
    "languages, opt_in, n",
    [(["pl"], False, 9), (["pl"], True, 11), (["en"], False, 2), (["pl", "en"], False, 11), ([], False, 0)],
)
def test_counts(languages, opt_in, n):
    assert len(C.detectors(languages, include_opt_in=opt_in)) == n


def test_repeated_language_counts_once():
    assert C.detectors(["pl", "pl"]) == C.detectors(["pl"])


def test_other_languages_get_cross_language_detectors_only():
    rows = C.detectors(["pl", "en"])
    assert sorted(d.entity for d in rows if d.lang == "en") == ["CREDIT_CARD", "EMAIL_ADDRESS"]


def test_opt_in_adds_krs_and_postal_code():
    added = {d.entity for d in C.detectors(include_opt_in=True)} - {d.entity for d in C.detectors()}
    assert added == {"PL_KRS", "PL_POSTAL_CODE"}


@pytest.mark.parametrize("entity", ["PL_PESEL", "PL_NIP", "PL_REGON", "IBAN_CODE", "CREDIT_CARD"])
def test_checksum_tier(entity):
    assert next(d for d in C.detectors() if d.entity == entity).score == 0.85


@pytest.mark.parametrize("entity", ["PL_ID_CARD", "PL_PASSPORT", "PHONE_NUMBER", "EMAIL_ADDRESS"])
def test_shape_tier(entity):
    assert next(d for d in C.detectors() if d.entity == entity).score == 0.4


def test_entities_and_types_are_one_to_one():
    assert len(C.TYPE_OF_ENTITY) == len(C.ENTITY_OF_TYPE) == 11


def test_unknown_entity_is_an_error():
    with pytest.raises(ValueError, match="no detector finds 'US_SSN'"):
        C.only(C.detectors(), ["US_SSN"])


def test_pii_type_must_fit_into_a_token():
    with pytest.raises(ValueError, match="PII type"):
        C.custom_detector("x", "x", pii_type="customer-id", score=0.5)


def test_context_override_and_exclusion():
    rows = C.with_context(C.detectors(), {"pl_pesel": ["moje"]})
    assert next(d for d in rows if d.name == "pl_pesel").context == ("moje",)
    assert len(C.excluding(C.detectors(), ["EMAIL_ADDRESS", "CREDIT_CARD"])) == 7


def test_catalog_table(spark):
    table = C.catalog_frame(spark, C.detectors(include_opt_in=True))
    assert table.count() == 11 and table.where("has_checksum").count() == 5
