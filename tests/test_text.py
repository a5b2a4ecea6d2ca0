from __future__ import annotations

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import headers, text


def test_clean_text(evaluate):
    values = [None, "", "  ", "\t", "NULL", " none ", "Null", " x ", "abcdef", "nulls"]
    want = [None, None, None, None, None, None, None, "x", "abcdef", "nulls"]
    assert evaluate(text.clean_text, values) == want
    assert evaluate(lambda c: text.clean_text(c, 3), [" abcdef ", "ab", "é€😀x"]) == ["abc", "ab", "é€😀"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_strip_is_python_strip(evaluate, values):
    values = [v for v in values if "\ud800" > max(v, default="a")]
    assert evaluate(text.strip, values) == [v.strip() for v in values]


def test_tax_id_and_padding(evaluate):
    values = [None, "", "0000", "12.345.678/0001-95", "000-1", "abc"]
    assert evaluate(text.tax_id, values) == [None, None, None, "12345678000195", "0001", None]
    ids = [None, "", "7599886842", "12345678901", "123456789012", "1" * 15]
    assert evaluate(text.national_id_key, ids) == [
        None, None, "07599886842", "12345678901", "00123456789012", "1" * 15,
    ]


def test_postal_and_holder_ids(evaluate):
    values = [None, "01.310-100", "00000-000", ""]
    assert evaluate(text.postal_code, values) == ["00000000", "01310100", "00000000", "00000000"]
    assert evaluate(lambda c: text.postal_code(c, None), values) == [None, "01310100", None, None]
    ids = ["12345678901", "1234567890", "123456789", "00000000000", "123456789012", None]
    want = ["12345678901", "01234567890", None, None, None, None]
    assert evaluate(text.shareholder_id, ids) == want


def test_phone_parts(evaluate):
    values = ["123456789", "(11) 2345-6789", "11 92345-6789", "551192345678", "00000000000", None]
    assert evaluate(text.phone_area, values) == [None, "11", "11", None, None, None]
    assert evaluate(text.phone_number, values) == [None, "23456789", "923456789", None, None, None]


def test_emails(evaluate):
    values = [" A@B.com ", "PENDENTE", "x@y", "n/a", None, "a b@c.de", "first.last+t@sub.dom.org"]
    assert evaluate(text.email_or_null, values) == [
        "a@b.com", None, None, None, None, None, "first.last+t@sub.dom.org",
    ]
    lists = ["A@b.com, c@d.org , pendente, bad@x,", "", None]
    assert evaluate(text.email_list, lists) == [["a@b.com", "c@d.org"], [], None]


def test_fold_name(evaluate):
    values = ["São Paulo", " D'Oeste - SP ", "ça\tva", "ẞß", None, "  ", "Mogi  das   Cruzes"]

    def expected(v):
        if v is None:
            return ""
        plain = unicodedata.normalize("NFD", v.strip().upper())
        plain = "".join(c for c in plain if unicodedata.category(c) != "Mn")
        return re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9 ]+", "", plain)).strip()

    # The capital sharp s has no upper-case expansion and is dropped by both.
    assert evaluate(text.fold_name, values) == [expected(v) for v in values]


def test_task_rules(evaluate):
    names = [" pesquisa  de   preço ", None, " NULL ", "Outra", "Desruptura"]
    assert evaluate(text.task_name, names) == ["PESQUISA DE PREÇO", None, None, "OUTRA", "DESRUPTURA"]
    clean = ["PESQUISA DE PREÇO", "DESRUPTURA", "OUTRA", None, "MONTAGEM PONTO EXTRA"]
    assert evaluate(text.task_type, clean) == [
        "undefined", "disruption", "undefined", "undefined", "extra_point_assembly",
    ]
    english = [" reposição ", "Ponto Extra & Cia", "&&", None, "VENDAS"]
    assert evaluate(text.task_name_english, english) == [
        "replenishment", "ponto_extra_cia", None, None, "sales",
    ]


def test_sheet_cells(evaluate):
    cells = ["Post - Paid!", " NULL ", None, "__In  two parts", "¡¡", "Já-Pago"]
    want = ["post_paid", "current", "current", "in_two_parts", "current", "j_pago"]
    assert evaluate(lambda c: text.snake_case(c, "current"), cells) == want
    kinds = ["5 Weeks in month", "4 weeks", None, "5", "week 5"]
    assert evaluate(text.calculation_type, kinds) == [
        "five_weeks_in_month", "four_weeks_in_month", "four_weeks_in_month",
        "four_weeks_in_month", "five_weeks_in_month",
    ]
    logins = [" bob ", "#TBD", "#tbd", "", None, " "]
    assert evaluate(text.seller_login, logins) == ["bob", None, None, None, None, None]


def test_join_text_and_first_filled(evaluate):
    assert evaluate(text.join_text, [" A B  C ", None, ""]) == ["ABC", "", ""]
    pick = lambda c: text.first_filled(c, F.lit("  "), F.lit(" z "))
    assert evaluate(pick, [" a ", "", None]) == ["a", "z", "z"]


def test_headers():
    assert headers.normalise_header(" Dia\nde  Faturamento: ") == "dia_de_faturamento"
    assert headers.normalise_header("A__B_::") == "a_b"
    assert headers.plain_header("-Tipo fat\nDescrição") == "tipo_fat_descricao"
    assert headers.normalise_header(":") == ":"


def test_header_lookup(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["ORÇAMENTO", "Tipo fat\nDescr", "Farmer (Login User)", "x"])
    clean = headers.with_clean_headers(df)
    assert headers.contract_id_column(clean) == "orçamento"
    assert headers.calculation_column(clean) == "tipo_fat_descr"
    assert headers.login_column(clean, "farmer") == "farmer_(login_user)"
    assert headers.login_column(clean, "hunter") is None
