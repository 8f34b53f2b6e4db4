"""The closed contract of an observation row."""

from __future__ import annotations

# Fixed values of the row contract: they must equal what the logs carry.
VERSION = 4
AXES = ("input", "output", "cache_read", "cache_write", "cache_write_1h", "image", "audio", "input_audio_cache", "internal_reasoning", "image_output", "audio_output")
FEES = ("web_search", "search", "fetch")
LIMITS = ("context", "output")
MODALITIES = ("image", "embeddings", "speech", "transcription", "video", "rerank", "decisions")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
REQUIRED = ("schema", "source", "model_id", "observed_at")

_RATES = "struct<" + ",".join(f"{a}:double" for a in AXES) + ">"
WHEN = "struct<days:array<string>,window:array<int>,timezone:string,min_tokens:bigint,mode:string>"
OVERRIDES = f"array<struct<when:{WHEN},rates:{_RATES},quota_multiplier:double>>"
RATES = _RATES
PROVENANCE = "struct<url:string,name:string,fx_rate:double,fx_rate_date:string>"
ROW = (
    "schema int, source string, model_id string, observed_at string, modality string, effective_at string, removed boolean, currency string, "
    f"rates {RATES}, overrides {OVERRIDES}, fees struct<{','.join(f'{x}:double' for x in FEES)}>, limits struct<{','.join(f'{x}:bigint' for x in LIMITS)}>, "
    f"unmapped string, provenance {PROVENANCE}"
)
FIELDS = tuple(x.strip().split(" ")[0] for x in ("schema,source,model_id,observed_at,modality,effective_at,removed,currency,rates,overrides,fees,limits,unmapped,provenance").split(","))
#: What a change is judged by: all but these.
INCOMPARABLE = ("schema", "observed_at", "provenance")
KEY = ("source", "model_id")
