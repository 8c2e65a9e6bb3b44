"""Default catalogs: published identities that decide which rows match.

Users may load their own with ``navloom.sources.catalogs``; these are the
defaults, in catalog order (the order decides the first usable instrument).
"""

# Look-through instruments.
# (aliases, category, us_equity_pct, data_date, source_name, source_url)
INSTRUMENTS = [
    (["纳指 ETF 汇添富", "纳指ETF汇添富"], "us_equity", 100.0, None,
     "汇添富纳斯达克100ETF联接基金招募说明书中的目标ETF与标的指数说明",
     "https://pdf.dfcfw.com/pdf/H2_AN202608141827963362_1.pdf"),
    (["纳指生物科技 ETF 汇添富", "纳指生物科技ETF汇添富", "汇添富纳斯达克生物科技ETF"], "us_equity", 100.0, None,
     "汇添富纳斯达克生物科技ETF联接基金2026年第2季度报告中的目标ETF与标的指数说明",
     "https://pdf.dfcfw.com/pdf/H2_AN202607211827186990_1.pdf"),
    (["大成纳斯达克100ETF（QDII）", "大成纳斯达克100ETF(QDII)", "大成纳斯达克100ETF"], "us_equity", 100.0, None,
     "大成纳斯达克100ETF联接基金招募说明书中的目标ETF与标的指数说明",
     "https://pdf.dfcfw.com/pdf/H2_AN202510011753863690_1.pdf"),
    (["华安纳斯达克100交易型开放式指数证券投资基金", "华安纳斯达克100交易型开放式指数证券投资", "华安纳斯达克100ETF"], "us_equity", 100.0, None,
     "华安纳斯达克100ETF联接基金招募说明书中的目标ETF与标的指数说明",
     "https://pdf.dfcfw.com/pdf/H2_AN202509191746477335_1.pdf"),
    (["广发纳斯达克100交易型开放式指数证券投资基金", "广发纳指100ETF"], "us_equity", 100.0, None,
     "广发纳斯达克100ETF联接基金招募说明书中的目标ETF与标的指数说明",
     "https://pdf.dfcfw.com/pdf/H2_AN202606051823274925_1.pdf"),
    (["INVESCO QQQ TRUST SERIES 1"], "us_equity", 100.0, None,
     "Invesco QQQ official product page",
     "https://www.invesco.com/qqq-etf/en/home.html"),
    (["INVESCO SEMICONDUCTORS ETF"], "us_equity", 100.0, None,
     "Invesco PSI official product page",
     "https://www.invesco.com/us/financial-products/etfs/product-detail?audienceType=Investor&ticker=PSI"),
    (["PWR S&P 500 EQ WGT TECH"], "us_equity", 100.0, None,
     "Invesco RSPT official product page",
     "https://www.invesco.com/us/financial-products/etfs/product-detail?audienceType=Investor&ticker=RSPT"),
    (["INVESCO NASDAQ 100 ETF"], "us_equity", 100.0, None,
     "Invesco QQQM official product page",
     "https://www.invesco.com/us/financial-products/etfs/product-detail?audienceType=Investor&ticker=QQQM"),
    (["VANECK SEMICONDUCTOR ETF"], "us_equity", 100.0, None,
     "VanEck SMH official product page",
     "https://www.vaneck.com/us/en/investments/semiconductor-etf-smh/"),
    (["FIRST TRUST NASDQ 100 TECH I", "FIRST TRUST NASDAQ 100 TECH"], "us_equity", 100.0, None,
     "First Trust QTEC official product page",
     "https://www.ftportfolios.com/Retail/Etf/EtfSummary.aspx?Ticker=QTEC"),
    (["TECHNOLOGY SELECT SECT SPDR"], "us_equity", 100.0, None,
     "State Street XLK official product page",
     "https://www.ssga.com/us/en/intermediary/etfs/technology-select-sector-spdr-fund-xlk"),
    (["ENERGY SELECT SECTOR SPDR"], "us_equity", 100.0, None,
     "State Street XLE official product page",
     "https://www.ssga.com/us/en/intermediary/etfs/energy-select-sector-spdr-fund-xle"),
    (["SPDR S&P BIOTECH ETF"], "us_equity", 100.0, None,
     "State Street XBI official product page",
     "https://www.ssga.com/us/en/intermediary/etfs/spdr-sp-biotech-etf-xbi"),
    (["VANGUARD S&P 500 ETF"], "us_equity", 100.0, None,
     "Vanguard VOO official product page",
     "https://investor.vanguard.com/investment-products/etfs/profile/voo"),
    (["SPDR BBG BARC 1-3 MONTH TBIL", "SPDR BLOOMBERG 1-3 MONTH T-BILL"], "fixed_income", 0.0, None,
     "State Street BIL official product page",
     "https://www.ssga.com/us/en/intermediary/etfs/spdr-bloomberg-1-3-month-t-bill-etf-bil"),
    (["FRK FTSE KOREA UCITS ETF", "FRANKLIN FTSE KOREA UCITS ETF"], "non_us_equity", 0.0, None,
     "Franklin FTSE Korea UCITS ETF official product page",
     "https://www.franklintempleton.lu/our-funds/price-and-performance/products/27869/SINGLCLASS/franklin-ftse-korea-ucits-etf/IE00BHZRR030"),
    (["CSETF GOLD"], "commodity", 0.0, None,
     "iShares Gold ETF (CH) official product page",
     "https://www.ishares.com/ch/professionals/en/products/261149/ishares-gold-ch-fund"),
    (["UBS GOLD ETF"], "commodity", 0.0, None,
     "UBS Fund Management official product-name notice",
     "https://www.ubs.com/content/news/en/2025/03/12/notice-to-shareholders/_jcr_content/root/contentarea/mainpar/gridcontrol/col_1/linklistnewlook_copy/link.1767675788.file/PS9jb250ZW50L2RhbS9hc3NldHMvbmV3cy8yMDI1LzAzLzEyL25vdGljZS10by1zaGFyZWhvbGRlcnMucGRm/notice-to-shareholders.pdf"),
    (["ISHARES GOLD TRUST", "ISHARES GOLD TRU"], "commodity", 0.0, None,
     "iShares Gold Trust official product page",
     "https://www.ishares.com/us/products/239561/ishares-gold-trust"),
]

# Contract benchmarks.
# (id, display_name, aliases, market_scope, market_label, asset_class,
#  style_label, structure, excluded_target)
BENCHMARKS = [
    ("nasdaq-100", "纳斯达克100指数",
     ["纳斯达克100指数", "纳斯达克100", "NASDAQ-100 Index", "NASDAQ 100 Index", "NASDAQ100 Index"],
     "us", "美国", "equity", "大盘成长", "standard", False),
    ("russell-1000-growth", "罗素1000成长指数",
     ["罗素1000成长指数", "Russell 1000 Growth Index"],
     "us", "美国", "equity", "大盘成长", "standard", False),
    ("sp-500-growth", "标普500成长指数",
     ["标普500成长指数", "S&P 500 Growth Index"],
     "us", "美国", "equity", "大盘成长", "standard", False),
    ("sp-500", "标普500指数",
     ["标普500指数", "标准普尔500指数", "S&P 500 Index", "S&P500 Index"],
     "us", "美国", "equity", "大盘宽基", "standard", False),
    ("sp-100-equal-weight", "标普100等权重指数",
     ["标普100等权重指数", "标准普尔100等权重指数", "S&P 100 Equal Weight Index"],
     "us", "美国", "equity", "大盘等权", "standard", False),
    ("msci-usa", "MSCI美国指数",
     ["MSCI美国指数", "MSCI USA Index"],
     "us", "美国", "equity", "宽基", "standard", False),
    ("dow-jones-industrial-average", "道琼斯工业平均指数",
     ["道琼斯工业平均指数", "Dow Jones Industrial Average", "DJIA"],
     "us", "美国", "equity", "蓝筹宽基", "standard", False),
    ("sp-us-information-technology", "标普美国信息科技指数",
     ["标普美国信息科技指数", "标普信息科技指数", "S&P 500 Information Technology Index"],
     "us", "美国", "equity", "信息科技", "standard", False),
    ("phlx-semiconductor", "费城半导体指数",
     ["费城半导体指数", "PHLX Semiconductor Sector Index", "NASDAQ US Smart Semiconductor Index"],
     "us", "美国", "equity", "半导体", "standard", False),
    ("nyse-fang-plus", "NYSE FANG+指数",
     ["NYSE FANG+指数", "NYSE FANG+ Index", "NYSE FANG Plus Index"],
     "us", "美国", "equity", "科技主题", "standard", False),
    ("msci-world", "MSCI世界指数",
     ["MSCI世界指数", "MSCI World Index"],
     "global", "全球发达市场", "equity", "全球宽基", "standard", False),
    ("msci-acwi", "MSCI所有国家世界指数",
     ["MSCI所有国家世界指数", "MSCI全球所有国家指数", "MSCI All Country World Index", "MSCI ACWI Index"],
     "global", "全球", "equity", "全球宽基", "standard", False),
    ("msci-world-information-technology", "MSCI全球信息科技指数",
     ["MSCI全球信息科技指数", "MSCI ACWI Information Technology Index", "MSCI World Information Technology Index"],
     "global", "全球", "equity", "信息科技", "standard", False),
    ("msci-emerging-markets", "MSCI新兴市场指数",
     ["MSCI新兴市场指数", "摩根士丹利资本国际新兴市场指数", "MSCI Emerging Markets Index"],
     "global", "新兴市场", "equity", "多市场宽基", "standard", False),
    ("bloomberg-global-electric-vehicles", "彭博全球新能源汽车指数",
     ["彭博全球新能源汽车指数", "Bloomberg Electric Vehicles Index", "Bloomberg Global Electric Vehicles Index"],
     "global", "全球", "equity", "新能源汽车", "standard", False),
    ("ftse-100", "富时100指数",
     ["富时100指数", "FTSE 100 Index"],
     "non_us", "英国", "equity", "大盘宽基", "standard", False),
    ("dax", "德国DAX指数",
     ["德国DAX指数", "DAX指数", "DAX Index"],
     "non_us", "德国", "equity", "大盘宽基", "standard", False),
    ("nikkei-225", "日经225指数",
     ["日经225指数", "日经225", "Nikkei 225 Index"],
     "non_us", "日本", "equity", "大盘宽基", "standard", False),
    ("topix", "东证指数",
     ["东证指数", "东京证券交易所股票价格指数", "TOPIX Index"],
     "non_us", "日本", "equity", "宽基", "standard", False),
    ("nifty-50", "印度Nifty 50指数",
     ["印度Nifty 50指数", "Nifty 50 Index", "NIFTY 50 Index"],
     "non_us", "印度", "equity", "大盘宽基", "standard", False),
    ("vn-30", "越南VN30指数",
     ["越南VN30指数", "VN30 Index"],
     "non_us", "越南", "equity", "大盘宽基", "standard", False),
    ("euro-stoxx-50", "欧洲斯托克50指数",
     ["欧洲斯托克50指数", "EURO STOXX 50 Index"],
     "non_us", "欧洲", "equity", "区域宽基", "standard", False),
    ("sp-gsci", "标普高盛商品总指数",
     ["标普高盛商品总指数", "S&P GSCI Commodity Total Return Index", "S&P GSCI Index"],
     "global", "全球", "commodity", "综合商品", "standard", False),
    ("bloomberg-commodity", "彭博商品指数",
     ["彭博商品指数", "Bloomberg Commodity Index"],
     "global", "全球", "commodity", "综合商品", "standard", False),
    ("london-gold", "伦敦金价格",
     ["伦敦金价格", "伦敦金下午定盘价", "London Gold Price PM Fix", "LBMA Gold Price PM"],
     "global", "全球", "commodity", "黄金", "standard", False),
    ("bloomberg-global-aggregate", "彭博全球综合债券指数",
     ["彭博全球综合债券指数", "Bloomberg Global Aggregate Bond Index"],
     "global", "全球", "bond", "综合债券", "standard", False),
    ("ftse-developed-reits", "富时发达市场REIT指数",
     ["富时发达市场REITs指数", "富时发达市场REIT指数", "FTSE EPRA Nareit Developed Index"],
     "global", "全球发达市场", "reit", "REIT", "standard", False),
    ("cboe-vix", "CBOE波动率指数",
     ["标普500波动率指数", "芝加哥期权交易所波动率指数", "CBOE Volatility Index", "VIX Index"],
     "us", "美国", "volatility", "波动率", "volatility", False),
    ("hang-seng", "恒生指数",
     ["恒生指数", "Hang Seng Index"],
     "excluded", "中国香港", "equity", "宽基", "standard", True),
    ("hang-seng-tech", "恒生科技指数",
     ["恒生科技指数", "Hang Seng TECH Index"],
     "excluded", "中国香港", "equity", "科技", "standard", True),
    ("msci-china", "MSCI中国指数",
     ["MSCI中国指数", "MSCI China Index"],
     "excluded", "中国", "equity", "宽基", "standard", True),
    ("csi-overseas-china-internet", "中证海外中国互联网指数",
     ["中证海外中国互联网指数", "CSI Overseas China Internet Index"],
     "excluded", "中国", "equity", "互联网", "standard", True),
    ("msci-asia-pacific-ex-japan", "MSCI亚太指数（不含日本）",
     ["MSCI亚太指数不含日本", "摩根斯坦利综合亚太指数不含日本", "MSCI AC Asia Pacific Index ex Japan"],
     "excluded", "泛亚洲", "equity", "区域宽基", "standard", True),
    ("csi-hk-us-china-technology", "中证香港美国上市中美科技指数",
     ["中证香港美国上市中美科技指数", "中证香港美国上市中美科技"],
     "excluded", "中国及中国香港", "equity", "科技主题", "standard", True),
    ("csi-300", "沪深300指数",
     ["沪深300指数", "CSI 300 Index"],
     "excluded", "中国", "equity", "大盘宽基", "standard", True),
    ("ftse-china", "富时中国指数",
     ["富时中国50指数", "富时中国A股自由流通全盘指数", "富时中国不含B股全盘指数", "FTSE China 50 Index"],
     "excluded", "中国", "equity", "宽基", "standard", True),
    ("csi-china-theme", "中证境内及香港主题指数",
     ["中证健康产业指数", "中证香港创新药指数", "中证香港上市可交易内地消费指数", "中证内地消费主题指数", "中证TMT产业主题指数", "中证港美上市全球智能汽车主题指数", "中证新能源汽车指数", "中证信息指数"],
     "excluded", "中国及中国香港", "equity", "行业主题", "standard", True),
]

# Exchange-traded funds watched by the premium table.
# (code, name, exchange, market_id, category, benchmark_group, source_url)
EXCHANGE_FUNDS = [
    ("513500", "标普500ETF博时", "SSE", 1, "broad_market", "标普500",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159612", "标普500ETF国泰", "SZSE", 0, "broad_market", "标普500",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159655", "标普500ETF华夏", "SZSE", 0, "broad_market", "标普500",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("513650", "标普500ETF南方", "SSE", 1, "broad_market", "标普500",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159513", "纳斯达克100ETF大成", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159659", "纳斯达克100ETF招商", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159632", "纳斯达克ETF华安", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("513300", "纳斯达克ETF华夏", "SSE", 1, "broad_market", "纳指100",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("513390", "纳指100ETF博时", "SSE", 1, "broad_market", "纳指100",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("513870", "纳指ETF富国", "SSE", 1, "broad_market", "纳指100",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159941", "纳指ETF广发", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("513100", "纳指ETF国泰", "SSE", 1, "broad_market", "纳指100",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("513110", "纳指ETF华泰柏瑞", "SSE", 1, "broad_market", "纳指100",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159660", "纳指ETF汇添富", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159501", "纳指ETF嘉实", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159696", "纳指ETF易方达", "SZSE", 0, "broad_market", "纳指100",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159577", "美国50ETF汇添富", "SZSE", 0, "broad_market", "美国50",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("513850", "美国50ETF易方达", "SSE", 1, "broad_market", "美国50",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("513400", "道琼斯ETF鹏华", "SSE", 1, "broad_market", "道琼斯",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159509", "纳指科技ETF景顺", "SZSE", 0, "sector_theme", "行业主题",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("513290", "纳指生物科技ETF汇添富", "SSE", 1, "sector_theme", "行业主题",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159502", "标普生物科技ETF嘉实", "SZSE", 0, "sector_theme", "行业主题",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("159529", "标普消费ETF景顺", "SZSE", 0, "sector_theme", "行业主题",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
    ("513350", "标普油气ETF富国", "SSE", 1, "sector_theme", "行业主题",
     "https://www.sse.com.cn/assortment/fund/etf/home/"),
    ("159518", "标普油气ETF嘉实", "SZSE", 0, "sector_theme", "行业主题",
     "https://www.szse.cn/market/product/list/etfList/index.html"),
]
