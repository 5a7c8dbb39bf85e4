"""Word lists, lookup tables, patterns and constants that results depend on."""

# fixed values: stop words removed before token comparison
STOP_WORDS = (
    "the", "a", "an", "is", "are", "was", "were", "it", "its", "i",
    "in", "of", "to", "and", "or", "for", "with", "by", "on", "at",
    "that", "this", "which", "what", "how", "has", "have", "had",
    "be", "been", "being", "do", "does", "did", "will", "would",
    "could", "should", "may", "might", "from", "as", "not", "more",
    "so", "if", "then", "than", "but", "when", "where", "who", "all",
    "also", "between", "about", "over", "per", "each", "both",
    "above", "after", "before", "since", "while", "following",
    "based", "provided", "context", "source", "retrieved",
)

# fixed values: state to region
STATE_REGION = {
    "SP": "Southeast", "RJ": "Southeast", "MG": "Southeast", "ES": "Southeast",
    "PR": "South", "SC": "South", "RS": "South",
    "BA": "Northeast", "CE": "Northeast", "PE": "Northeast", "MA": "Northeast", "PB": "Northeast",
    "RN": "Northeast", "AL": "Northeast", "SE": "Northeast", "PI": "Northeast",
    "AM": "North", "PA": "North", "RO": "North", "AC": "North", "RR": "North", "AP": "North", "TO": "North",
    "MT": "Midwest", "GO": "Midwest", "MS": "Midwest", "DF": "Midwest",
}

# fixed values: complaint themes and their keywords
COMPLAINT_THEMES = {
    "Late Delivery / Not Received": [
        "not received", "nao recebi", "ainda nao chegou", "nunca chegou", "prazo", "atrasado", "atraso",
        "demora", "demorou", "entrega atrasada", "not delivered", "late delivery", "delayed"],
    "Wrong / Damaged Product": [
        "produto errado", "wrong product", "diferente", "danificado", "quebrado", "damaged", "broken",
        "different from", "veio diferente", "produto com defeito", "defeito"],
    "Poor Product Quality": [
        "qualidade", "ruim", "pessima", "horrivel", "muito fraco", "poor quality", "bad quality", "cheap",
        "nao funciona", "nao funcionou", "nao presta", "lixo", "fake", "falsificado"],
    "Seller Communication Issues": [
        "sem resposta", "nao respondeu", "ignorou", "no response", "atendimento", "customer service",
        "support", "vendedor", "seller"],
    "Packaging Issues": [
        "embalagem", "packaging", "caixa amassada", "caixa aberta", "mal embalado", "badly packed",
        "box damaged"],
    "Missing Items": [
        "faltou", "faltando", "missing", "incompleto", "nao vieram", "vieram so", "so vieram",
        "missing items"],
    "Refund / Return Problems": [
        "reembolso", "refund", "devolucao", "return", "cancelamento", "cancelei",
        "nao recebi reembolso", "estorno"],
}

# fixed values: words that send a question to retrieval
COMPLEX_WORDS = (
    "which", "highest", "lowest", "most", "least", "best", "worst", "differ", "difference", "compare", "between",
    "change", "trend", "why", "how did", "what caused", "frequently", "category", "region", "state", "month",
)

# fixed values: ordered patterns of single-metric questions
DIRECT_PATTERNS = (
    (r"how many (?:total )?(?:delivered )?orders", "total_delivered_orders"),
    (r"total (?:number of )?(?:delivered )?orders", "total_delivered_orders"),
    (r"number of (?:delivered )?orders", "total_delivered_orders"),
    (r"how many (?:active )?sellers", "total_sellers"),
    (r"total (?:number of )?(?:active )?sellers", "total_sellers"),
    (r"number of (?:active )?sellers", "total_sellers"),
    (r"how many customers", "total_customers"),
    (r"total (?:number of )?customers", "total_customers"),
    (r"how many (?:total )?reviews", "total_reviews"),
    (r"total (?:number of )?reviews", "total_reviews"),
    (r"what (?:is|was) (?:the )?(?:overall )?(?:total )?revenue", "total_revenue"),
    (r"total revenue", "total_revenue"),
    (r"overall average delivery (?:time|days)", "avg_delivery_days"),
    (r"average delivery (?:time|days) (?:across all)?", "avg_delivery_days"),
    (r"overall avg delivery", "avg_delivery_days"),
    (r"what (?:is|was) (?:the )?average delivery", "avg_delivery_days"),
    (r"(?:what|average) (?:is )?(?:the )?(?:overall )?avg(?:erage)? review score", "avg_review_score"),
    (r"average review score", "avg_review_score"),
    (r"what percentage (?:of )?(?:customer )?reviews (?:are )?negative", "pct_negative_reviews"),
    (r"(?:percentage|pct|percent) (?:of )?negative reviews", "pct_negative_reviews"),
    (r"how many (?:unique )?products", "total_products"),
)

# fixed values: answer text around each metric: (before, digits, after)
ANSWER_TEMPLATES = {
    "total_delivered_orders": ("There are **", 0, "** delivered orders in the dataset."),
    "total_sellers": ("There are **", 0, "** active sellers on the platform."),
    "total_customers": ("There are **", 0, "** unique customers in the dataset."),
    "total_reviews": ("There are **", 0, "** customer reviews in the dataset."),
    "total_revenue": ("Total revenue from delivered orders is **BRL ", 2, "**."),
    "avg_delivery_days": ("The overall average delivery time across all sellers is **", 1, " days**."),
    "avg_review_score": ("The overall average customer review score is **", 2, " / 5.0**."),
    "pct_negative_reviews": ("**", 1, "%** of customer reviews are negative (score 1 or 2)."),
    "total_products": ("There are **", 0, "** unique products in the dataset."),
}

# fixed values: phrases that make an answer count as off-topic
NON_ANSWERS = ("rag pipeline not initialized", "no relevant context found", "i could not find", "retrieval-only")

# fixed values: recall assumed for a directly computed answer, by grade
DIRECT_RECALL = {"PASS": 0.92, "PARTIAL": 0.65, "FAIL": 0.18}
DIRECT_RECALL_DEFAULT = 0.50

# fixed values: published purchase and spend model parameters, horizon and cut-offs
BGNBD = {"r": 0.3457, "alpha": 4.5401, "a": 1e-9, "b": 1e-9}
GAMMA_GAMMA = {"p": 1.8368, "q": 6.1421, "v": 1022.1015}
ACTUAL_MEAN_SPEND = 350.69
FORECAST_DAYS = 90
MIN_TENURE_DAYS = 90
SILENCE_RISK_DAYS = 180
ALIVE_RISK_CUTOFF = 0.5
PENALTIES = (0.001, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0)

# fixed values: costs and thresholds of the alert economics
COST_FP_USD = 50.0
CHARGEBACK = 2.5
