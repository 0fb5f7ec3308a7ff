import pytest

from lakeloom.llm.dom import read

RAW = [
    "<script>for(i=0;i<n;i++){f(i)}</script>", "<script>if (a<b) c = '<!-- ';</script>", "<script>s = \"it's <b\";</script>",
    "<SCRIPT>x<![CDATA[ y</SCRIPT >", "<style>a::before{content:'<x'}</style>", "<textarea><!-- never closed, <p</textarea>",
    "<script></script>", "<script src='a.js' async></script><script>i<n</script>",
]


@pytest.mark.parametrize("raw", RAW)
def test_markup_in_raw_elements_takes_nothing_of_what_follows(raw):
    plain = read("<body><article><p>before</p><p>the main text</p></article><p>after</p></body>")
    page = read(f"<body><article><p>before</p>{raw}<p>the main text</p></article><p>after</p></body>")
    assert [t for _, _, t, _ in page.runs] == [t for _, _, t, _ in plain.runs] == ["before", "the main text", "after"]
    assert page.tags == plain.tags and page.parents == plain.parents


def test_a_raw_element_without_an_end_takes_the_rest():
    assert [t for _, _, t, _ in read("<p>a</p><script>i<n <p>b</p>").runs] == ["a"]


ARTICLE = "<article><p>before</p><p>the main text</p></article>"
MAIN = ["before", "the main text"]


@pytest.mark.parametrize("html", [
    f"<html><head><title>t</title>{ARTICLE}</html>",
    f"<html><head><title>t</title><meta charset=utf-8><script>i<n</script>{ARTICLE}</body></html>",
    f"<head><title>t</title><link rel=x>\n{ARTICLE}",
    f"<title>t</title>{ARTICLE}",
    f"<body><div><select><option>a<option>b</div>{ARTICLE}",
    f"<body><select><option>a<option>b{ARTICLE}",
    f"<body><button>press{ARTICLE}",
    f"<body><div><button>press</div>{ARTICLE}",
    f"<body><object data=x>{ARTICLE}",
    f"<body><video src=x>{ARTICLE}",
    f"<body><button>a<button>b</button>{ARTICLE}",
])
def test_omitted_end_tags_take_no_main_text(html):
    assert [t for _, _, t, _ in read(html).runs if t.strip()] == MAIN


def test_text_right_after_a_head_is_text():
    assert [t for _, _, t, _ in read("<head><title>t</title>the main text").runs] == ["the main text"]


def test_ended_silent_elements_stay_silent():
    html = "<body><video><p>no</p></video><select><option>no</select><button>no</button><object><p>no</p></object><p>yes</p>"
    assert [t for _, _, t, _ in read(html).runs] == ["yes"]
