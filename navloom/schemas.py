"""Column types of the domain tables; nothing is inferred from data."""

FUNDS = "code string, name string, fund_type string"
HOLDER_PERIODS = "report_date date, fund_count long, period_key string"
HOLDERS = (
    "period_key string, code string, institution_pct double, personal_pct double, "
    "total_shares_100m double"
)
FUND_PAGES = (
    "code string, inception_date date, scale_100m_cny double, scale_report_date date, "
    "purchase_status string, purchase_status_text string, page_agency_limit_cny long, "
    "latest_nav_date date, latest_nav_value double, fund_page_url string"
)
NAV = "code string, date date, nav double, equity_return_pct double, unit_money string"
SERIES = "date date, value double"
ANNOUNCEMENTS = (
    "code string, announcement_id string, title string, published_date date, "
    "on_latest_page boolean"
)
DOCUMENTS = (
    "code string, announcement_id string, published_date date, source_url string, "
    "text string, error string"
)
REPORT_HOLDINGS = (
    "announcement_id string, rank int, fund_name string, weight_pct double, "
    "reported_category string"
)
REPORT_TOTALS = (
    "announcement_id string, report_date date, direct_us_pct double, fund_investment_pct double"
)
TRANSITIONS = (
    "code string, notice_seq long, transition_seq int, effective_date date, "
    "published_date date, direct_amount_cny long, agency_amount_cny long, "
    "global_amount_cny long, global_status string, share_aggregation string, "
    "all_channels_combined boolean, confidence string, source_url string"
)
QUOTES = (
    "code string, arrival long, price double, iopv double, source_discount_pct double, "
    "change_pct double, turnover_cny double, quote_date_raw string, updated_seconds long, "
    "quote_name string"
)
PREMIUM_RECORDS = (
    "code string, market_price_cny double, iopv_cny double, source_discount_pct double, "
    "premium_pct double, change_pct double, turnover_cny double, quote_date date, "
    "updated_at timestamp, quote_source_url string"
)
EXCHANGE_FUNDS = (
    "code string, name string, exchange string, market_id int, category string, "
    "benchmark_group string, source_url string"
)
INSTRUMENTS = (
    "position int, aliases array<string>, category string, us_equity_pct double, "
    "data_date date, source_name string, source_url string"
)
BENCHMARKS = (
    "position int, id string, display_name string, aliases array<string>, market_scope string, "
    "market_label string, asset_class string, style_label string, structure string, "
    "excluded_target boolean"
)
ISSUES = "code string, reason string, detail string, severity string"
WARNINGS = "seq long, text string"
VIOLATIONS = "rule_id string, key string, message string"
EXCLUSIONS = "reason string, label string, code string"
