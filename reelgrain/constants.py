"""Published defaults, thresholds and formats that results depend on."""

# File name suffixes.
VIDEO_EXTENSIONS = (".mp4", ".mov", ".avi")
MODEL_EXTENSIONS = (".obj", ".mtl", ".png", ".jpg")

# Frame sampling.
MAX_FRAMES = 300
FPS_CAP = 2.0

# Frame preprocessing (width, height) and model input.
FRAME_SIZE = (1024, 768)
INPUT_RESIZE = 256
INPUT_CROP = 224
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

# Validation bounds.
FILE_BYTES = (1_000_000, 500_000_000)
DURATION_SECONDS = (10, 600)
RESOLUTION_PATTERN = "1920x1080|3840x2160"
MIN_TEXTURE = (2048, 2048)
MIN_CONFIDENCE = 0.25

# Monitoring limits.
SLA_SECONDS = 1800
LAG_SECONDS = 900
STORAGE_ALERT = 0.75
SLOW_RUN_FACTOR = 2.0
POLYGON_DRIFT = 0.15
VERTEX_DENSITY_DRIFT = 0.20
MIN_ENTROPY_BITS = 4.7
MAX_POSE_ERROR_M = 0.3
MAX_RMSE_M = 0.005
MIN_SSIM = 0.92

# Arrival polling and retention.
POLL_SECONDS = 300
ARRIVAL_TIMEOUT_SECONDS = 7200
RETENTION_DAYS = 30
COLD_AFTER_DAYS = 30
PROMPT_SAMPLE = 5
