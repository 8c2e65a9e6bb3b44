"""Values that decide results: thresholds, word lists, patterns, labels.

Patterns are Java regular expressions.  ``(?U)`` makes ``\\s`` and ``\\d`` cover
the ideographic space, the no-break space and full-width digits.
"""

# Thresholds and windows.
BENCHMARK_WINDOW_YEARS = 3
BENCHMARK_BUFFER_DAYS = 14
MAX_STALENESS_DAYS = 7
MIN_OBSERVATIONS = 140
MIN_SPAN_DAYS = 1000
WEEKS_PER_YEAR = 52
RETURN_HORIZONS = {1: "one_year", 3: "three_year", 5: "five_year", 10: "ten_year"}
MIN_RETURN_PCT = {3: 30.0, 5: 60.0, 10: 100.0}
MIN_DIRECT_LIMIT_CNY = 200
MIN_US_EQUITY_PCT = 50.0
MIN_AGE_YEARS = 3
TOP = 10
PERIOD_COVERAGE = 0.95
ALLOCATION_MAX_AGE_DAYS = 120
NOTICE_LOOKBACK_DAYS = 550
NOTICE_LIMIT = 12
SERIES_TOLERANCE = 1e-9
NAV_MATCH_TOLERANCE = 1e-8
RESIDUAL_FLOOR_PCT = 0.01
UNRESOLVED_WARNING_PCT = 0.005

# Fund types, keywords and routing names.
OVERSEAS_INDEX_TYPE = "指数型-海外股票"
QDII_PREFIX = "QDII"
EXCLUDED_FUND_TYPES = ["QDII-纯债", "QDII-混合债", "QDII-商品"]
GEOGRAPHY_KEYWORDS = ["亚洲", "中国", "港"]
MAIN_LIST = "us_main"
SUPPLEMENT_LIST = "global_supplement"
ROUTE_CONFIRMED = "confirmed_us_exposure"
ROUTE_BELOW = "us_exposure_below_threshold"
ROUTE_GEOGRAPHY = "us_main_name_geography_override"
STRUCTURAL_CATEGORIES = ["us_equity", "non_us_equity", "fixed_income", "commodity"]
PREMIUM_GROUPS = ["标普500", "纳指100", "美国50", "道琼斯", "行业主题"]

# Share-class patterns on fund names.
SHARE_REJECT = (
    r"美元|港币|后端|人民币[CD]|[CD](?:类)?(?:份额)?人民币|"
    r"(?:\(|（|/|\s)[CD](?:类|份额|\)|）|$)|[CD](?:类|份额|\)|）|$)"
)
SHARE_ACCEPT = r"人民币A|A(?:类|份额)?人民币|A类|A1(?:\(|$)|A(?:\(|$)"
SUMMARY_FOREIGN_SHARE = r"人民币[CD]|[CD](?:类)?(?:份额)?人民币|\([CD]类份额\)|（[CD]类份额）"

# Titles of disclosures.
QUOTA_TITLE = r"大额申购|申购.{0,20}(?:限额|业务上限)|(?:限额|业务上限).{0,20}申购|恢复.{0,12}申购"
REPORT_TITLE_REJECT = r"摘要|提示性公告"
CHINESE_YEAR_DIGITS = ("〇零○ＯO一二三四五六七八九", "00000123456789")
REPORT_YEAR = r"(?U)([0-9〇零○ＯO一二三四五六七八九]{4})\s*年"
REPORT_QUARTER = r"(?U)第\s*([1234一二三四])\s*季度报告"
REPORT_HALF = r"(?:中期|半年度)报告"
REPORT_ANNUAL = r"年度报告"

# Wording of quota notices.
DIRECT_CHANNEL = (
    r"(?<!非)直销销售机构|(?<!非)直销机构|直销渠道|直销中心柜台|电子直销平台|网上直销平台"
)
AGENCY_CHANNEL = r"非直销销售机构|代销机构|代销渠道"
CHANNEL_EXPLICIT = r"(?:不得超过|不超过|高于|超过|限额(?:调整)?为)\s*([\d][\d,.]*)\s*(万元|元)"
AMOUNT = r"(?<![\d-])([\d][\d,.]*)\s*(万元|元)"
CLOSING_AMOUNT = r"([\d][\d,.]*)\s*(万元|元)$"
LIMIT_WORD = r"上限|超过|不得超过|不超过|限制|暂停办理|累计申购"
CHANNEL_BEFORE, CHANNEL_AFTER, LIMIT_CONTEXT = 80, 220, 55
WEIGHT_GAP_CHARS = 55
GLOBAL_AMOUNTS = [
    r"限制\s*(?:大额\s*)?申购\s*(?:及\s*定期定额投资\s*)?金额\s*"
    r"(?:[（(]\s*单\s*位\s*[：:]\s*(?:人民币\s*)?元\s*[）)])?\s*([\d,.]+)",
    r"调整\s*申购\s*(?:[（(]\s*含\s*定期定额投资\s*[）)])?\s*金额\s*"
    r"(?:[（(]\s*单\s*位\s*[：:]\s*人民币\s*元\s*[）)])?\s*([\d,.]+)",
    r"(?:累计申购|申购金额)[^。；]{0,180}?(?:不超过|不得超过|不应超过|上限调整为)\s*"
    r"(?:人民币\s*)?([\d,.]+)\s*(?:人民币\s*)?(万元|元)",
    r"超过\s*([\d,.]+)\s*(万元|元)[^。；]{0,50}?(?:申购|大额申购)",
    r"(?:金额累计限额|业务限额)为\s*([\d,.]+)\s*(?:人民币\s*)?(万元|元)",
]
EFFECTIVE_DATES = [
    r"(?:调整|暂停|恢复)[^。；]{0,30}?起始日\s*(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日",
    r"自\s*(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日(?:起|（含)",
]
FUTURE_DATE = r"自\s*(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日(?:起|（含[^）]*）)"
FUTURE_CLAUSE_CHARS = 500
CHANGE_VERB = r"恢复|调整|暂停"
RESTORE = r"恢复(?:办理)?大额申购"
RESTORE_PENDING = r"恢复(?:办理)?大额申购.{0,40}(?:具体时间|时间).{0,20}另行公告"
STILL_CAPPED = r"暂停接受.*?超过"
ALL_CHANNELS = "全部销售机构累计"
MANY_CHANNELS = r"多家销售渠道.{0,60}累计计算"
SHARES_COMBINED = r"A[类级].{0,60}C[类级].{0,35}(?:合并计算|合计金额)|A类、C类.{0,30}合计金额"
SHARES_SEPARATE = (
    r"分别计算|分开计算|单独计算(?:限额)?|单一基金份额|单一类别|A类人民币份额或C类人民币份额"
)

# Wording of prospectuses and product summaries.
BENCHMARK_STARTS = [
    r"(?:本基金(?:选择)?的?)?业绩比较基准(?:为|是|采用|：|:)\s*",
    r"(?i)业绩比较基准\s*(?=(?:\d|经|标|纳|MSCI|摩根|彭博|伦敦|富时|恒生|中证|人民币|美元|[A-Z]))",
]
BENCHMARK_STOP = (
    r"风险收益特征|业绩比较基准的选择理由|如果今后|若今后|在法律法规|"
    r"基金管理人可|本基金为|本基金选择|本基金设置|本基金采取"
)
BENCHMARK_TOKENS = r"指数|价格|利率|INDEX|PRICE|VIX"
BENCHMARK_TAIL_CHARS, BENCHMARK_STATEMENT_CHARS, BENCHMARK_FALLBACK_CHARS = 1200, 800, 3000
STRUCTURE_INVERSE = r"(?iu)反向|做空|Inverse|Short"
STRUCTURE_LEVERAGED = r"(?iu)(?:[2-9]|两|三)倍(?:做多|多头|杠杆)|杠杆指数|Leveraged|Ultra"
STRUCTURE_VOLATILITY = r"(?iu)波动率|VIX|Volatility"
EXPENSE_RATE = r"基金运作综合费率\s*[（(]\s*年化\s*[）)]\s*([0-9]+(?:\.[0-9]+)?)\s*%"
EXPENSE_DATE = (
    r"(?:综合费率[^。]{0,80})?测算日期为\s*(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日"
)

# Wording of periodic reports.
REPORT_PAGE_HEADER = (
    r"(?Umd)^.*?[0-9〇零○ＯO一二三四五六七八九]{4}\s*年"
    r"(?:第\s*[1234一二三四]\s*季度|半年度|年度).*?报告\s*$\n^\s*\d+\s*$\n?"
)
SPLIT_NUMBERS = [
    (r"(?U)(?<=\d)\.\s+(?=\d{1,2}(?:\s|$))", "."),
    (r"(?U)(\d{1,3}(?:,\d{3})+\.\d)\s+(\d)(?=\s)", "$1$2"),
    (r"(?U)(\d{1,3}(?:,\d{3})+,\d{1,2})\s+(\d{1,2}\.\d{2})(?=\s)", "$1$2"),
    (r"(?U)(\d{1,3}(?:,\d{3})+)\s+(\.\d{2})(?=\s)", "$1$2"),
]
COUNTRY_HEADING = (
    r"(?:报告期末|期末)在各个国家（地区）证券市场的(?:股票及存托\s*凭证|权益)投资分\s*布"
)
COUNTRY_CHARS = 1200
NEXT_HEADING = r"\n\s*\d+(?:\.\d+)+\s*"
COUNTRY_US = r"美国\s+([\d,.]+)\s+(\d+(?:\.\d+)?)"
ASSET_HEADING = r"报告期末基金资产组合情况"
ASSET_CHARS = 2500
FUND_AMOUNT = r"(?:^|\s)2\s+基金投资\s+([\d,.]+)\s+\d+(?:\.\d+)?"
FUND_DASH = r"(?:^|\s)2\s+基金投资\s+(?:[－—-]\s*){1,2}(?:\s|$)"
NET_ASSETS = r"(?s)期末基金\s*资产\s*净值(.{0,1400}?)5\.\s*期末基金\s*份额\s*净值"
NET_ASSET_VALUE = r"(?<!\d)(\d[\d,]*\.\d{2})(?!\d)"
HOLDINGS_START = r"前十名基金投资明\s*细"
HOLDINGS_END = r"投资组合报告附注"
HOLDING_ROW = r"(?Umd)^\s*(10|[1-9])\s+"
HOLDING_NAMES = [
    r"^(.+?)\s+(?:ETF\s*基\s*金|指数基\s*金|开放式\s*基\s*金|基\s*金)\s+",
    r"^(.+?)\s+ETF\s+(?:交易型|契约型)",
    r"^(.+?)\s+QDII\s+(?:交易型|契约型|开放式)",
    r"^(.+?)\s+(?:债\s*券\s*型|股\s*票\s*型|混\s*合\s*型|商\s*品\s*型|权\s*益\s*类)\s+",
]
HOLDING_PERCENT = r"(?<![\d,])(\d{1,3}\.\d{2})(?!\d)"
HOLDING_COMMODITY = r"商\s*品\s*型"
HOLDING_BOND = r"债\s*券\s*型"
HOLDING_SHORT_NAME = 12
HOLDING_CONTINUATION = r"\d{1,3}\.\d{2}\s+([A-Z][A-Z0-9& ]+?ETF)(?:\s+[A-Z][a-z]|\s*$)"

# Fields of fund pages and of raw payloads.
PAGE_SCALE = r"规模</a>：\s*([\d,.]+)\s*(亿元|万元|元)（(\d{4}-\d{2}-\d{2})）"
PAGE_INCEPTION = r"成\s*立\s*日</span>[：:]\s*(\d{4}-\d{2}-\d{2})"
PAGE_BUY_STATUS = r'var fundBuyStatus = "([^"]+)"'
PAGE_IS_SALE = r"var fundIsSale = (true|false)"
PAGE_STATE = r"(?s)交易状态：(.{0,450}?)购买手续费"
PAGE_LIMIT = r"单日累计购买上限\s*([\d,.]+)\s*(万元|元)"
PAGE_LATEST_NAV = (
    r"(?s)单位净值</a></span>\s*\(</span>(\d{4}-\d{2}-\d{2})\)</p>"
    r".*?<dd class=\"dataNums\">\s*<span[^>]*>([\d.]+)</span>"
)
CASH_DIVIDEND = r"派现金\s*([\d.]+)\s*元"
RAW_NAV = r"(?s)var\s+Data_netWorthTrend\s*=\s*(\[.*?\]);"
RAW_DATA_ARRAY = r"(?s)data:(\[.*?\]),record:"
RAW_PAGE_COUNT = r'pages:"(\d+)"'
RAW_FUND_LIST_HEAD = r"^\x{FEFF}?var r =\s*"
DOCUMENT_URL = "https://pdf.dfcfw.com/pdf/H2_{}_1.pdf"
FUND_PAGE_URL = "https://fund.eastmoney.com/{}.html"
QUOTE_PAGE_URL = "https://quote.eastmoney.com/{}{}.html"

# Labels of reports and exclusions.
EXCLUSION_LABELS = {
    "three_year_return_below_threshold": "近三年收益低于阈值",
    "five_year_return_below_threshold": "有完整五年历史且近五年收益低于阈值",
    "ten_year_return_below_threshold": "有完整十年历史且近十年收益低于阈值",
    "quota_unresolved": "申购额度无法可靠解析",
    "direct_limit_below_threshold": "直销额度低于阈值",
    "ranking_cap": "超过每榜上限",
}
SHARE_RULE_LABELS = {
    "A/C combined": "A/C合并", "A/C separate": "A/C分别", "not applicable": "不适用",
}
CHANNEL_RULE_LABELS = {
    "all sales channels combined": "全部渠道合计",
    "direct and agency limits differ": "直销/代销分别",
    "same fund-level limit": "同一基金级限额",
}
TYPE_TAGS = {"QDII-REITs": "REIT", "QDII-FOF": "FOF", "指数型-海外股票": "指数"}
STRUCTURE_TAGS = {"leveraged": "杠杆", "inverse": "反向", "volatility": "波动率策略"}
UNRECOGNIZED = "未识别"
COMPOSITE_STYLE = "复合风格"
COMPOSITE_MARKET = "复合市场"

# Warnings that may be published; all others block a run.
REPORTABLE_PREFIXES = [
    "跳过未完整披露的持有人报告期", "纳指100基准更新失败，使用完整缓存：",
    "合同基准告警 ", "产品概要告警 ", "持有费率告警 ", "额度剔除 ",
    "美国主榜仅 ", "全球补充榜仅 ", "场内溢价告警：",
]
REPORTABLE_PAIRS = [
    ("无法按 ", "仓位仅计入可能上限"), ("前十大基金之外尚有", "仅计入可能上限"),
    ("美股占比区间", "按确认下限进入全球补充榜"),
    ("的基金主页净值已更新至 ", "已强制重新验证完整历史并按后者计算"),
    ("的申购额度无法确定；引用前请核对关联公告", ""), ("quota notice could not be parsed", ""),
]
REPORTABLE_TEXTS = ["美国主榜当前没有符合全部条件的基金。", "全球补充榜当前没有符合全部条件的基金。"]
DIGEST_PREFIXES = [
    "跳过未完整披露的持有人报告期", "纳指100基准更新失败，使用完整缓存：",
    "合同基准告警 ", "产品概要告警 ", "持有费率告警 ", "额度剔除 ",
    "美国主榜仅 ", "全球补充榜仅 ",
]

# The columns of the flat export, in output order.
FLAT_COLUMNS = [
    "ranking_list", "routing_reason", "rank", "code", "name", "fund_type", "management_style",
    "product_structure_tags", "contract_benchmark_status", "contract_benchmark_name",
    "contract_benchmark_text", "contract_benchmark_weight_pct", "contract_benchmark_components",
    "contract_market_scope", "contract_market_label", "contract_asset_class", "contract_style_label",
    "contract_structure", "contract_prospectus_published_date", "contract_source_url",
    "product_summary_status", "product_summary_source_url", "holding_cost_status",
    "holding_cost_annualized_pct", "holding_cost_measurement_date", "holding_cost_source_url",
    "institution_holding_ratio_pct", "holder_report_date", "inception_date", "scale_100m_cny",
    "scale_report_date", "nav_history_start_date", "nav_history_end_date", "one_year_return_pct",
    "one_year_max_drawdown_pct", "one_year_performance_start_date", "one_year_performance_end_date",
    "three_year_return_pct", "three_year_max_drawdown_pct", "three_year_performance_start_date",
    "three_year_performance_end_date", "five_year_return_pct", "five_year_performance_start_date",
    "five_year_performance_end_date", "ten_year_return_pct", "ten_year_performance_start_date",
    "ten_year_performance_end_date", "nasdaq100_correlation", "nasdaq100_beta", "nasdaq100_tracking_error_pct",
    "nasdaq100_observations", "nasdaq100_start_date", "nasdaq100_end_date", "three_year_annualized_return_pct",
    "return_drawdown_ratio", "us_equity_confirmed_pct", "us_equity_possible_pct", "us_equity_status",
    "us_equity_report_date", "us_equity_source_url", "purchase_status", "direct_limit", "agency_limit",
    "share_class_rule", "channel_rule", "quota_confidence", "fund_page_url", "performance_source_url",
    "quota_source_urls",
]
