import pytest
from pyspark.sql import functions as F

from matchloom.functions import text as T

CASES = [
    ("COCA COLA 1L C/6", "coca cola 1l"),
    ("MONSTER BRANCO S/ACUCAR C/6 UNID", "monster branco sem acucar"),
    ("Água Mineral sem Gás 1,5 litro", "agua mineral sem gas 1.5l"),
    ("TANQUERAY GIN 750ML UNID", "tanqueray gin 750ml"),
    ("Ração Whiskas Melhor Por Natureza Gatos Adultos Salmão 2,7kg",
     "racao whiskas melhor natureza gatos adultos salmao 2.7kg"),
    ("Macarrão Instantâneo Yakissoba Carne com Molho Japonês Nissin U.F.O. 97g",
     "macarrao instantaneo yakissoba carne com molho japones nissin u f 97g"),
    ("12X15 GR", "15g"), ("12x350ml", "12x350ml"), ("CERVEJA LT 350ML", "cerveja lata 350ml"),
    ("Refrigerante 2 LT", "refrigerante 2l"), ("Peso 500.", "peso 500."), ("Vitamina E", "vitamina"),
    ("CORONA CERO SUNBREW LONG NECK 330ML - C/24", "corona cero sunbrew long neck 330ml"),
    ("", ""), ("de da", ""), (None, ""),
    ("Nike™ №5 ㎏ ＡＢ１ Straße", "nike o5kg ab1 strae"),      # capitals of a decomposition are punctuation
]


def test_normalise(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(CASES)], "i int, a string, b string")
    for r in df.select("a", "b", T.normalise(F.col("a")).alias("n")).collect():
        assert r.n == r.b, r.a


def test_normalise_twice_changes_nothing(spark):
    df = spark.createDataFrame([(b,) for _, b in CASES if b and "." not in b], "b string")
    for r in df.select("b", T.normalise(F.col("b")).alias("n")).collect():
        assert r.n == r.b


@pytest.mark.parametrize("brand, want", [("Cola", "coca cola 2l"), ("Pepsi", "coca cola 2l pepsi"),
                                         (None, "coca cola 2l"), ("", "coca cola 2l")])
def test_brand(spark, brand, want):
    df = spark.createDataFrame([("COCA COLA 2L", brand)], "name string, brand string")
    assert T.with_document(df, "name", "brand", True).first().norm == want


def test_fold_covers_every_decomposition(spark):
    import unicodedata
    chars = [chr(p) for p in range(0xA0, 0x3400)] + list("ﬁﬀ㎖㎏ＡＢ１𝐀𝟙")
    df = spark.createDataFrame([(c, unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode())
                                for c in chars], "c string, want string")
    assert df.filter(T.fold_accents(F.col("c")) != F.col("want")).count() == 0


def test_predicates(spark):
    df = spark.createDataFrame([("ÁGUA 2L",), ("agua C/6",), ("12",)], "t string")
    rows = df.select(T.is_upper(F.col("t")).alias("u"), T.has_accent(F.col("t")).alias("a"),
                     T.matches(F.col("t"), T.ORDER_PATTERNS["case_of_n"]).alias("c"),
                     T.matches(F.col("t"), T.ORDER_PATTERNS["litres"]).alias("l")).collect()
    assert [tuple(r) for r in rows] == [(True, True, False, True), (False, False, True, False), (True, False, False, False)]
