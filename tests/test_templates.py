import pytest

from spindrift.functions.templates import Call, expand

VECTORS = {
    "convert|5|km|mi": "5 km",
    "convert|5|to|10|km": "5 to 10 km",
    "convert|5": None,
    "lang|fr|bonjour": "bonjour",
    "lang|fr|x|3=y|z=1": "y",
    "frac": "/",
    "frac|2": "1/2",
    "frac|1|2|3": "1 2/3",
    "frac|1|2|3|4": None,
    "As of|2010|5": "As of May 2010",
    "as of|2010|5|2|post=,": "as of 2 May 2010, ",
    "as of|alt=now|2010": "now",
    "as of|2010|spring": "as of spring 2010",
    "birth date|1990|1|5": "January 5, 1990",
    "birth date|1990|13": "13, 1990",
    "birth date|1990": "1990",
    "birth date|1990|0|5": "0 5, 1990",
    "start date|2010|5|3|10|30|15|Z": "10:30:15, May 3, 2010 (UTC)",
    "start date|2010|spring|3": "2010",
    "start date|2010|5": "May 2010",
    "film date|2010|5|3": "May 3, 2010",
    "film date|2010|x|3": "3, 2010",
    "coord|40|N|74|W|display=title": "40°N 74°W",
    "coord|12.5|-45.3": "12.5°N 2.5°W",
    "coord|-12.5|45.3": "12.5°S -12.5°E",
    "coord|1|2|3|N|5|6|7|W": "1°2'3\"N 5°6'7\"W",
    "coord|1|2|N|5|6|W": "1°2'N 5°6'W",
    "coord|1|2|3": None,
    "nihongo|Tokyo|東京|Tōkyō": "Tokyo(東京)",
    "nihongo||東京|Tōkyō": "Tōkyō(東京, Tōkyō)",
    "nihongo|Tokyo": None,
    "ushr|CA|1": "CA's 1th congressional district",
    "ushr|AK|AL": "AK's at-large congressional district",
    "jct|I|5|SR|99": "I-5/SR-99",
    "jct|I|5|SR": "I-5/SR",
    "quote|Hi|Bob": '"Hi"-Bob',
    "quote|text=Hi|character=Al": '"Hi"-Al',
    "quote|Hi|Bob|Book|character=Al": '"Hi"-Al, in Bob, Book',
    "quote|author=x": None,
    "poem quote|Hi|char=Al": '"Hi"-Al',
    "ubl|a|b": "a\nb",
    "zh|t=甲|s=乙|c=": "甲; 乙",
    "korean|hanja=x|y": "Korean: y; Hanja: x",
    "sortname|A|B": "A B",
    "sortname|A": "A",
    "val|e=3": "10 ^ 3",
    "val|3|1": "3 ± 1",
    "circa": "circa",
    "c.|1|2": "c. 1-2",
    "USS|Iowa": "USS Iowa",
    "USS|Iowa|BB": "USS Iowa (BB)",
    "USS": None,
    "SS|a": "a",
    "nee": "née",
    "color box|red": "",
    "height|m=1.8|frac=2": "1.8 m",
    "isbn|1||2": "1, 2",
    "sic|a|?|b": "ab",
    "flagIOC|GER": "Germany",
    "flagIOC|zzz": "zzz",
    "flagIOCmedalist|Bo|GER": "Bo (GER)",
    "lang-xx|a|b": "b",
    "language|a": "a",
    "  Spaced   NDASH  ": " - ",
    "'s": "'s",
    "unknown|x": None,
    "": None,
}


@pytest.mark.parametrize(("source", "plain"), VECTORS.items())
def test_vectors(source, plain):
    assert expand(source) == plain


def test_parameters_fill_free_places():
    assert Call("t|2=b|a|c|x=1=2|+3=q").params == {"2": "b", "1": "a", "3": "c", "x": "1", "+3": "q"}


def test_given_names_take_no_place():
    assert Call("t|a|month=5|b").renamed(["year", "month", "day"]) == {"year": "a", "month": "5", "day": "b"}


def test_countries_may_be_given():
    assert expand("flagIOC|XYZ", {"xyz": "Somewhere"}) == "Somewhere"
