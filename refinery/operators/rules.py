"""Classification by rules: a pair of categories names candidates, whose keywords decide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER = "기타"


@dataclass(frozen=True)
class Choice:
    """Candidates in order, most specific first; without any, the fallback is the answer."""

    candidates: tuple[str, ...]
    fallback: str


# The choices of each (main, sub) category, and the keywords of each candidate.
CHOICES = {
    ("스킨케어", "스킨/토너"): Choice((), "토너"),
    ("스킨케어", "에센스/세럼/앰플"): Choice(("세럼", "앰플", "에센스"), "에센스"),
    ("스킨케어", "크림"): Choice((), "크림"),
    ("스킨케어", "로션"): Choice(("올인원", "로션"), "로션"),
    ("스킨케어", "미스트/오일"): Choice(("미스트", "페이스오일"), "페이스오일"),
    ("클렌징", "클렌징폼/젤"): Choice(("클렌징젤", "클렌징폼"), "클렌징폼"),
    ("클렌징", "오일/밤"): Choice(("클렌징밤", "클렌징오일"), "클렌징오일"),
    ("클렌징", "워터/밀크"): Choice(("클렌징밀크", "클렌징워터"), "클렌징워터"),
    ("클렌징", "필링&스크럽"): Choice((), "필링스크럽"),
    ("더모 코스메틱", "스킨케어"): Choice(("세럼", "앰플", "크림", "로션", "올인원", "토너", "에센스", "페이스오일", "미스트"), "에센스"),
    ("더모 코스메틱", "클렌징"): Choice(("클렌징젤", "클렌징오일", "클렌징밤", "클렌징워터", "클렌징밀크", "필링스크럽", "클렌징폼"), "클렌징폼"),
}
KEYWORDS = {
    "토너": r"토너|(?<![가-힣a-zA-Z0-9])토닉(?![가-힣a-zA-Z0-9])|toner|(?<![가-힣a-zA-Z0-9])스킨(?!케어|[가-힣a-zA-Z0-9])|skin(?!care)|패드|pad|소프너",
    "앰플": r"앰플|원액|스팟|ampoule",
    "세럼": r"세럼|serum|부스터|샷(?!건)|(?<![가-힣a-zA-Z])젤(?![가-힣a-zA-Z])|(?<![가-힣a-zA-Z])겔(?![가-힣a-zA-Z])",
    "에센스": r"에센스|essence",
    "크림": r"크림|cream",
    "올인원": r"올인원|all.?in.?one|멀티크림|멀티밤",
    "로션": r"로션|에멀전|에멀젼|유액|lotion|emulsion|모이스처라이저|moisturizer|플루이드|fluid|밀크(?!클렌)",
    "페이스오일": r"오일|아로마틱 케어|oil",
    "미스트": r"미스트|스프레이|하이드롤라|워터|에센스|오떼르말|오 떼르말|mist|픽서|픽싱|세팅|fixer|setting",
    "클렌징젤": r"젤|gel",
    "클렌징폼": r"폼|foam|워시|wash|비누|솝|soap|바|bar|버블|bubble|무스|mousse|휩|whip|클렌저|클렌져",
    "클렌징밤": r"밤(?!\s*크림)|발름|balm",
    "클렌징오일": r"오일|oil",
    "클렌징밀크": r"밀크|milk|크림\s*클렌|로션\s*클렌|클렌징\s*로션",
    "클렌징워터": r"워터|water|미셀라|micellar|리무버|remover|H2O",
    "필링스크럽": r"필링|스크럽|peeling|scrub",
}


def classify(name: Column, main: Column, sub: Column, raw_name: Column | None = None, choices: dict = CHOICES, keywords: dict = KEYWORDS, other: str = OTHER) -> Column:
    """The first candidate that the cleaned name holds, else the raw name, else the fallback; ``other`` where the pair has no rule."""
    out = F.lit(None).cast("string")
    for (m, s), choice in choices.items():
        answer = None
        for source in (name, raw_name):
            for c in choice.candidates if source is not None else ():
                hit = source.rlike("(?iuUd)" + keywords[c])
                answer = F.when(hit, F.lit(c)) if answer is None else answer.when(hit, F.lit(c))
        answer = F.lit(choice.fallback) if answer is None else answer.otherwise(F.lit(choice.fallback))
        out = F.when((main == m) & (sub == s), answer).otherwise(out)
    return F.coalesce(out, F.lit(other))
