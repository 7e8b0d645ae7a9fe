import pytest

from ringlens.llm.html_text import visible_text

PAGE = "<style>{}</style><p class=story>a</p><div class='x y'>b</div><div id=z>c</div>"
CASES = {
    "@media print{.story,p{display:none}}": "abc",
    "@media PRINT { .story { display: none } p { display:none } }": "abc",
    "@media (max-width: 600px){.x{display:none}} #z{display:none}": "ab",
    "@media screen and (min-width: 600px){.x{display:none}}": "ac",
    "@media(max-width:40em){.x{display:none}}": "abc",
    "@media print, screen{.x{display:none}}": "ac",
    "@media not print{.x{display:none}}": "ac",
    "@supports (display: grid){@media print{.x{display:none}} .story{display:none}}": "bc",
    "@media print{@media screen{.x{display:none}}}": "abc",
    ".x{display:none} .x{display:block}": "abc",
    ".x{display:block} .x{display:none}": "ac",
    ".x{display:none} .y{display:block}": "abc",
    "div.x{display:none} .x{display:block}": "ac",
    ".x{display:none!important} .x{display:block}": "ac",
    "#z{display:none} div{display:block}": "ab",
    "@import url(a.css); .x{display:none}": "ac",
    "@charset 'u}'; /* .story{display:none} */ .x{content:'}';display:none}": "ac",
    "@keyframes k{from{display:none} to{display:block}} .x{display:none}": "ac",
    "@font-face{font-family:x} .x{display:none": "ac",
    ".x{-ms-display:none;display:block}": "abc",
}


@pytest.mark.parametrize("style", CASES)
def test_cascade(style):
    assert "".join(visible_text(PAGE.format(style)).split()) == CASES[style]


def test_inline_display_beats_the_sheet():
    assert visible_text("<style>.x{display:none}</style><p class=x style='display:block'>a</p><p style='display:block;display:none'>b") == "a"
    assert visible_text("<style>.x{display:none !important}</style><p class=x style='display:block'>a</p>b") == "b"
