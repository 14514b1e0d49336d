"""Language profiles: the patterns and constants that the operators' meaning rests on."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Profile:
    """Patterns are Java regular expressions; character sets are regex class bodies."""

    terminators: str
    closers: str
    quote_open: str
    quote_close: str
    comma: str
    dash: str
    ellipsis: str
    exclaim: tuple[str, ...]
    question: tuple[str, ...]
    full_stop: str
    classes: dict[str, str]
    headings: tuple[str, ...]
    markers: dict[str, str]
    words: str
    kana: str = ""
    stopwords: tuple[str, ...] = ()
    old_letters: str = ""
    old_kana: str = ""
    trailing_note: str = r"^[（(].{0,60}[）)]$"
    heading_length: int = 20
    dialogue_limit: int = 200
    orthography: dict[str, str] = field(default_factory=lambda: {"new": "新字新仮名", "mixed": "混在", "old": "旧字旧仮名", "none": "不明"})

    @property
    def sentence(self) -> str:
        return f"[^{self.terminators}]*[{self.terminators}][{self.closers}]*|[^{self.terminators}]+"

    @property
    def quote(self) -> str:
        both = self.quote_open + self.quote_close
        return f"[{self.quote_open}][^{both}]*[{self.quote_close}]"

    @property
    def dialogue_head(self) -> str:
        return f"^[　\\s]*[{self.quote_open}]"


# ---- fixed values: what the results are defined by -------------------------------------------
JAPANESE = Profile(
    terminators="。！？!?",
    closers="」』）)〉》】］\"'、",
    quote_open="「『",
    quote_close="」』",
    comma="、",
    dash="――",
    ellipsis="……",
    exclaim=("！", "!"),
    question=("？", "?"),
    full_stop="。",
    classes={"kanji": "一-鿿㐀-䶿", "hiragana": "ぁ-ゟ", "katakana": "ァ-ヿ"},
    headings=(
        "^[一二三四五六七八九十百千]+$",
        "^[一二三四五六七八九十百千]+[、．.　 ]",
        "^[０-９0-9]+$",
        "^[０-９0-9]+[、．.　 ]",
        "^第[一二三四五六七八九十百千０-９0-9]+[^。、]{0,8}$",
        "^[上中下]([　\\s].{0,18})?$",
        "^(序|跋|序章|終章|序詞|序文|前編|中編|後編|前篇|中篇|後篇|はしがき|まえがき|あとがき|附記|付記|結語|結び)([　\\s].{0,18})?$",
        "^その[一二三四五六七八九十百０-９0-9]+",
    ),
    markers={
        "ようだ": "[のただ]よう(?!に(思|見え|見受|感じ|なっ|なり|なる|し|せ|言|云|申|願|祈|命|頼|聞|覚え|考え)"
                  "|な(気|感じ|口調|顔|声|様子|風|ふう|具合)|です|であ|でご)[なにだ]",
        "みたい": "みたい[なにだでな]",
        "ごとし": "(のごとく|のごとき|ごとし|如く|如き)",
        "まるで": "まるで",
        "あたかも": "(あたかも|恰も)",
        "さながら": "さながら",
        "似る": "(に似た|に似て|を思わせる|を思わす)",
        "見紛う": "(と見紛う|と見まがう|かと疑う)",
    },
    words="[一-鿿]{2,4}|[ァ-ヿー]{3,8}",
    kana="ぁ-ゟァ-ヿー",
    stopwords=(
        "なかなか", "いよいよ", "ますます", "だんだん", "たびたび", "ときどき", "もともと", "それぞれ", "われわれ", "いろいろ", "しばしば",
        "まちまち", "ほとほと", "とにかく", "かえすがえす", "みすみす", "つれづれ", "とうとう", "わざわざ", "そうそう", "いていて",
    ),
    trailing_note=r"^[（(].{0,60}[）)]$",
    old_letters="學國實體發變聲會來氣當樂兒寫廣擧曉晝萬與舊黨點觀壹濟藝總歸戰傳醫櫻",
    old_kana="ゐゑヰヱ",
)
#: The 8 marks of a sparkline, lowest first.
SPARK = "▁▂▃▄▅▆▇█"
ERAS = (("明治", 1868, 1911), ("大正", 1912, 1925), ("戦前昭和", 1926, 1944), ("戦後", 1945, 2100))
FIRST_PUBLISHED = r"(?s)初出[：:].*?(18[6-9]\d|19\d\d|20\d\d)"
LICENCE = "クリエイティブ・コモンズ「([^」]+)」"
NO_LICENCE = "著作権切れ"
QUANTILES = (("p10", 0.10), ("p25", 0.25), ("median", 0.50), ("p75", 0.75), ("p90", 0.90))
SAMPLE_FILTER = {"min_chars": 3000, "max_chars": 300_000, "min_sentences": 40, "max_mean_length": 120}
NOVEL_CHARS = 50_000
CORPUS_NAMES = (
    "李徴", "袁傪", "メロス", "セリヌンティウス", "ジョバンニ", "カムパネルラ", "ゴーシュ", "紀昌", "喜助", "庄兵衛", "良平", "兵十", "禅智内供",
    "犍陀多", "豊太郎", "エリス", "多襄丸", "三四郎", "美禰子", "赤シャツ", "苦沙弥", "迷亭", "葉蔵", "かず子", "直治", "よだか", "山猫軒",
)
#: Structure bands in per cent of the text; turn candidates closer than turn_cluster are one turn.
BANDS = {"inciting_max": 15, "inciting_late": 20, "turn": (70, 89), "climax": (85, 97), "turn_cluster": 8, "ending_max": 9}
#: Metric, label, unit and band (ratio to the target; None: absolute tolerance).
CHECKS = (
    ("characters", "字数", "字", (0.9, 1.2)),
    ("sentence_length_mean", "平均文長", "字", (0.75, 1.3)),
    ("sentence_length_cv", "文長の振れ幅", "", (0.7, 1.4)),
    ("simile_per_1000", "直喩の密度（千字あたり）", "", (0.5, 1.6)),
    ("dialogue_ratio", "会話率", "", None),
)
DIALOGUE_TOLERANCE = 0.10
PLOT_BANDS = {"心境": {"dialogue_ratio": "no_floor", "simile_per_1000": (0.5, 3.0)}}
MARGIN = 0.05
UP, DOWN = "上げる", "下げる"
SECTION_SHARES = (("発端", 0.10), ("承", 0.70), ("転", 0.12), ("結", 0.05))
INFO_ITEMS = ("3-7",)
#: What is said of a structure outside the bands; names in braces stand for figures.
STRUCTURE_PROBLEMS = {
    "no_inciting": "発端の引用が本文に無い",
    "late_inciting": "発端が遅い: {inciting}%（基準 15% 以内）",
    "rather_late_inciting": "発端がやや遅い: {inciting}%（基準 15% 以内。境界）",
    "no_units": "承の単位のうち {missing} 件の引用が本文に無い",
    "number_of_units": "反復の単位数 {units}（{length}字なら {wanted}）",
    "no_direction": "反復に方向が答えられていない",
    "no_turn_quote": "転の引用が本文に無い",
    "no_turn": "転が答えられていない",
    "turn": "転の位置 {turn}%（{kind}: 基準 70〜89%）",
    "no_climax": "山の引用が本文に無い",
    "climax": "山の位置 {climax}%（基準 85〜97%）",
    "tail": "山から末尾まで {tail}%（基準 9% 以内）",
    "explained_ending": "結が説明で閉じている",
    "no_gap": "知識差が答えられていない",
}
#: What is said of a text by its measures.
TEXT_PROBLEMS = {
    "similes": "直喩が偏っている: 前半 {front} / 後半 {back}",
    "orthography": "正書法が新字新仮名でない",
    "name": "参照作品の固有名詞「{name}」が出ている",
}
NONFICTION = ("56823",)
PROFILE_METRICS = ("sentence_length_mean", "sentence_length_stdev", "dialogue_ratio", "kanji_ratio", "comma_per_sentence", "dash_per_1000",
                   "ellipsis_per_1000", "exclaim_per_1000")
ADVICE = (
    ("characters", UP, "新しい出来事や人物は足さない。承の各単位の描写と会話を厚くして伸ばす。転の位置は本文の8割前後を保つ。"),
    ("characters", DOWN, "筋は変えず、承の描写を削って縮める。転から結までは削らない。"),
    ("sentence_length_mean", UP, "短い文を読点でつないで一文に二つの動作や観察を入れる。会話文はそのままでよい。"),
    ("sentence_length_mean", DOWN, "長い文を二つに分ける。一文に一つの動作か観察にする。"),
    ("sentence_length_cv", UP, "長い文と短い文を隣り合わせる。段落の最後を短い断定で落とす。"),
    ("sentence_length_cv", DOWN, "極端に長い文を分け、極端に短い文を前後とつなぐ。"),
    ("simile_per_1000", UP, "描写の要所に直喩を足す。喩える先は手で触れられる具体物にする。"),
    ("simile_per_1000", DOWN, "直喩を減らす。残すのは喩える先が具体物で、その場面にしか使えないものだけ。"),
    ("dialogue_ratio", UP, "地の文で説明している人物の意図を、会話に置き換える。"),
    ("dialogue_ratio", DOWN, "会話の一部を地の文の要約か動作に置き換える。"),
)
# ---- end of fixed values -----------------------------------------------------------------------

#: For texts in Latin letters; the operators are the same.
LATIN = Profile(
    terminators=".!?",
    closers=")\\]\"'»”,",
    quote_open="«“",
    quote_close="»”",
    comma=",",
    dash="--",
    ellipsis="...",
    exclaim=("!",),
    question=("?",),
    full_stop=".",
    classes={"kanji": "a-z", "hiragana": "A-Z", "katakana": "0-9"},
    headings=("^[A-Z]+$", "^[0-9]+$", "^[0-9]+[.) ]", "^[A-Z][a-z]+$"),
    markers={w: f"(?:^|[^\\p{{L}}]){w}(?:[^\\p{{L}}]|$)" for w in ("the", "as", "de", "und", "que")},
    words="[A-Z][a-z]{2,7}",
    old_letters="äöüß",
    old_kana="ñç",
)
