"""Source registry and parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_SCHEMA = (
    "id string, name string, name_en string, lang string, kind string, url string, weight double, official boolean, "
    "relevance_filter boolean, max_items int, offset_minutes int, enabled boolean, needs_overseas_network boolean"
)

# The registered feeds.
SOURCES = (
    ("qbitai", "量子位", "QbitAI", "zh", "rss", "https://www.qbitai.com/feed", 1.10, False, False, None, None, True, False),
    ("infoq-ai", "InfoQ 中国 AI", "InfoQ China", "zh", "rss", "https://www.infoq.cn/feed/ai", 1.05, False, False, None, 480, True, False),
    ("leiphone", "雷锋网", "Leiphone", "zh", "rss", "https://www.leiphone.com/feed", 1.00, False, True, None, None, True, False),
    ("oschina", "开源中国", "OSChina", "zh", "rss", "https://www.oschina.net/news/rss", 0.90, False, True, None, None, True, False),
    ("ifanr", "爱范儿", "iFanr", "zh", "rss", "https://www.ifanr.com/feed", 0.90, False, True, None, None, True, False),
    ("sspai", "少数派", "Sspai", "zh", "rss", "https://sspai.com/feed", 0.85, False, True, None, None, True, False),
    ("solidot", "Solidot", "Solidot", "zh", "rss", "https://www.solidot.org/index.rss", 0.90, False, True, None, None, True, False),
    ("tmtpost", "钛媒体", "TMTPost", "zh", "rss", "https://www.tmtpost.com/rss.xml", 0.85, False, True, None, None, True, False),
    ("openai", "OpenAI News", "OpenAI News", "en", "rss", "https://openai.com/news/rss.xml", 1.30, True, False, 20, None, True, False),
    ("google-ai", "Google AI Blog", "Google AI Blog", "en", "rss", "https://blog.google/technology/ai/rss/", 1.25, True, False, None, None, True, True),
    ("techcrunch-ai", "TechCrunch AI", "TechCrunch AI", "en", "rss", "https://techcrunch.com/category/artificial-intelligence/feed/", 1.10, False, False, None, None, True, False),
    ("verge-ai", "The Verge AI", "The Verge AI", "en", "atom", "https://www.theverge.com/rss/ai-artificial-intelligence/index.xml", 1.05, False, False, None, None, True, False),
    ("mit-techreview-ai", "MIT Tech Review AI", "MIT Tech Review AI", "en", "rss", "https://www.technologyreview.com/topic/artificial-intelligence/feed", 1.10, False, False, None, None, True, False),
    ("simonw", "Simon Willison", "Simon Willison", "en", "atom", "https://simonwillison.net/atom/everything/", 1.00, False, True, None, None, True, False),
    ("hn", "Hacker News", "Hacker News", "en", "hn", "https://hn.algolia.com/api/v1/search_by_date", 1.20, False, False, None, None, True, False),
    ("arxiv", "arXiv cs.AI", "arXiv cs.AI", "en", "arxiv", "https://rss.arxiv.org/rss/cs.AI", 0.95, False, False, 20, None, True, False),
    ("venturebeat-ai", "VentureBeat AI", "VentureBeat AI", "en", "rss", "https://venturebeat.com/category/ai/feed/", 0.95, False, False, None, None, False, False),
)
# Kinds of announcements that are kept, and the tracks of the search.
ANNOUNCE_TYPES = ("new", "replace")
HN_TRACKS = {"query": "AI", "min_points_high": 80, "fresh_hours": 6, "min_points_fresh": 20, "page_size": 20}

# Limits, thresholds and weights that decide the same results.
WINDOW_DAYS, MAX_STORE_ITEMS, RETAIN_RUNS = 30, 4000, 60
MAX_SUMMARY_CHARS, SUMMARY_MIN_CHARS = 240, 20
STALE_SOURCE_DAYS, FUTURE_TOLERANCE_HOURS, MIN_PUBLISH_YEAR = 14, 2, 2000
DUP_CONTAINMENT, DUP_LENGTH_RATIO = 0.90, 0.70
CLUSTER_JACCARD, CLUSTER_SHARED_ENTITIES, RARE_ENTITY_DF = 0.45, 2, 3
CLUSTER_WINDOW_HOURS, MAX_POSTINGS = 72, 40
SCORE_WEIGHTS = {"source": 3.0, "cross": 2.5, "recency": 1.5, "signal": 0.8, "heat": 0.4}
RECENCY_HOURS, CROSS_SATURATION = 72, 4
HIGHLIGHT_SOURCES, HIGHLIGHT_HEAT, HIGHLIGHT_SIGNALS, HIGHLIGHT_ITEMS = 2, 150, 2, 5
IMAGE_MAX_CHARS, IMAGE_SCAN_TAGS = 600, 12
MAX_BYTES = 8 << 20

# Parts of image addresses that are no picture of the article.
IMAGE_DENY = (
    "/avatar", "/emoji", "/smiley", "gravatar", "/icon", "/logo", "/sprite",
    "pixel.gif", "spacer.gif", "blank.gif", "/badge", "/button", ".svg", "/tkrss/",
)
# Summaries that only navigate.
BOILERPLATE = (
    "点击查看原文", "点击阅读原文", "阅读全文", "查看全文", "阅读原文", "点击阅读", "详情请见", "关注我们", "扫码关注", "分享到",
    "read more", "continue reading", "learn more", "view original", "the post ", "appeared first on", "originally published", "submitted by",
)
# Whole lines that only navigate.
BOILERPLATE_PATTERNS = (
    r"^the post .{0,140}appeared first on .{1,60}$",
    r"^appeared first on .{1,60}$",
    r"^originally published (at|on) .{1,60}$",
    r"^submitted by .{1,60}$",
    r"^(read|learn|continue|view) more\b.{0,40}$",
    r"^点击?查看?原文.{0,10}$",
    r"^(阅读|查看)全文.{0,10}$",
)
# Terms of the topic filter.
LATIN_TERMS = (
    "AI", "AGI", "LLM", "LLMs", "GPT", "RAG", "GenAI", "ChatGPT", "Claude", "Gemini",
    "Llama", "Qwen", "DeepSeek", "Mistral", "Grok", "Copilot", "Midjourney", "Sora",
    "OpenAI", "Anthropic", "DeepMind", "HuggingFace", "NVIDIA", "TPU", "GPU",
    "transformer", "transformers", "multimodal", "agentic", "chatbot", "diffusion",
    "inference", "fine-tuning", "pretraining", "embedding", "hallucination",
    "artificial intelligence", "machine learning", "deep learning", "neural network",
    "large language model", "foundation model", "computer vision", "reinforcement learning",
    "robotics", "autonomous driving", "self-driving", "prompt engineering",
)
CJK_TERMS = (
    "人工智能", "大模型", "大语言模型", "智能体", "机器人", "具身智能", "深度学习", "机器学习", "神经网络", "多模态", "生成式", "生成式AI",
    "算力", "微调", "预训练", "推理", "幻觉", "提示词", "向量", "自动驾驶", "语音识别", "计算机视觉", "强化学习", "开源模型", "英伟达", "芯片", "智算",
)
# Signal categories and their terms.
SIGNALS = {
    "发布/上线": ("发布", "上线", "推出", "releases", "launches", "introduces", "unveils", "ships"),
    "开源": ("开源", "open-sources", "open source", "open-source", "weights"),
    "融资/并购": ("融资", "收购", "并购", "funding", "raises", "acquisition", "acquires", "IPO"),
    "安全": ("漏洞", "安全", "攻击", "泄露", "vulnerability", "exploit", "breach", "jailbreak"),
    "基准/榜单": ("榜单", "基准", "评测", "benchmark", "leaderboard", "SOTA", "state of the art"),
    "监管/政策": ("监管", "法案", "合规", "regulation", "lawsuit", "policy", "ban"),
}
# Capitalised words that name no particular thing.
ENTITY_STOP = (
    "A", "An", "The", "This", "That", "New", "How", "Why", "What", "When", "Where", "Who",
    "AI", "It", "In", "On", "For", "And", "Of", "To", "With", "Is", "Are", "As", "At",
    "Show", "Ask", "We", "You", "Your", "My", "Our", "Its", "Can", "Will", "Not",
    "After", "Before", "From", "By", "But", "Or", "If", "So", "Up", "Out", "Now",
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
    "Adaptive", "Agent", "Agents", "Agentic", "Application", "Applications", "Approach", "Architecture", "Benchmark", "Chip", "Chips",
    "Dataset", "Datasets", "Data", "Evaluation", "Framework", "GPU", "GPUs", "GenAI", "Guide", "Inference", "Intelligence", "Language",
    "Learning", "LLM", "LLMs", "Machine", "Method", "Model", "Models", "Network", "Networks", "Platform", "Policy", "Real", "Report",
    "Research", "Review", "Robotics", "Search", "Security", "Service", "Services", "Study", "System", "Systems", "Token", "Tokens",
    "Tool", "Tools", "Training", "Vision",
)


def dim_source(spark: SparkSession) -> DataFrame:
    """The registry as a dimension table; a fixed few rows, so it may be broadcast."""
    return spark.createDataFrame(SOURCES, SOURCE_SCHEMA)


def select_sources(only: list[str] | None = None) -> list[tuple]:
    """Enabled sources, or those named, enabled or not. An unknown name raises."""
    if not only:
        return [s for s in SOURCES if s[11]]
    known = {s[0]: s for s in SOURCES}
    if missing := [x for x in only if x not in known]:
        raise ValueError(f"unknown sources: {', '.join(missing)}")
    return [known[x] for x in only]
