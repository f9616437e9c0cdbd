"""Word lists, templates, thresholds and formats.

These must equal the values users already rely on, so they are stated plainly
here and nowhere else. ``{channel}`` in a template is the channel's own name.
"""

# --- Fixed values: status names and defaults -------------------------------
PENDING = "Pending"
IN_PROGRESS = "In Progress"
COMPLETED = "Completed"
FAILED = "Failed"
UNKNOWN = "Unknown"
OPEN_STATUSES = [PENDING, IN_PROGRESS]

# --- Fixed values: search result kinds and the series rule -----------------
KIND_VIDEO = "youtube#video"
KIND_PLAYLIST = "youtube#playlist"
TOP_RESULTS = 5
SERIES_MIN = 3
FIRST_PART_MARKS = ["part 1", "ep 1", "episode 1"]
FIRST_PART_MARKS_OLD = ["part 1"]
SERIES_PATTERN = r"part \d|ep\.?\s*\d|episode|series|complete guide|full course"
SPLIT_CAP = 10
SPLIT_CAP_OLD = 15
GENERIC_PARTS = 3
REASON_NONE = "No results"
REASON_PLAYLIST = "Top result is a playlist"
REASON_FIRST_PART = "Top result is Part 1 of a series"
REASON_SERIES = "/5 results suggest a multi-part topic"
REASON_SINGLE = "Topic is self-contained"

# --- Fixed values: error categories, first match wins, case-sensitive ------
ERROR_RULES = [
    ("COLAB_DEAD", ["Gradio", "Colab", "colab"]),
    ("NOTEBOOKLM_TIMEOUT", ["NotebookLM", "notebooklm"]),
    ("FFMPEG_FAIL", ["FFmpeg", "ffmpeg"]),
    ("TTS_FAIL", ["TTS", "WAV", "tts"]),
    ("WHISPER_FAIL", ["Whisper", "whisper"]),
    ("NOTION_API", ["Notion", "429"]),
    ("UPLOAD_FAIL", ["YouTube", "upload"]),
]
ERROR_OTHER = "UNKNOWN"
# Fixed value: a number that a log line gives as a status, not as an id or a count.
STATUS_NUMBER = r"(?i)(?:^|\b(?:http(?:/[0-9.]+)?|status|code|error)[ :=(]{{1,3}}){}\b"

# --- Fixed values: thresholds ----------------------------------------------
SCENE_GAP_S = 1.0
SCENE_TAIL_S = 3.0
PACE_MIN, PACE_MAX = 0.5, 2.0
PACE_FLOOR_S = 0.1
PACE_DEAD_BAND = 0.05
OUTRO_WORDS = 50
WORDS_PER_SECOND = 2.5
CHUNK_WORDS = 100
SPEED_MIN, SPEED_MAX = 0.85, 1.1
FRESH_MINUTES = 60
DEFAULT_HOUR = 18
ENOUGH_VIDEOS = 3
CATCH_UP_SECONDS = 60
LOG_KEEP = 50
RECENT_UPLOADS = 50
HISTORY_KEEP = 12
AUDIO_SHORT_S = 0.5
FADE_S = 1.0
MEDIA_FLOOR_BYTES = 10 * 1024
TEXT_FLOOR_BYTES = 1000
JUNK_FLOOR_BYTES = 100
DOWNLOAD_MAX_AGE_S = 120
DRIFT_MAX = 0.03

# --- Fixed values: file names ----------------------------------------------
PARTIAL_SUFFIX = ".crdownload"
MEDIA_SUFFIXES = [".mp4", ".wav", ".mp3", ".webm"]
UPLOAD_SUFFIXES = [".wav", ".txt", ".json"]
HTML_MARKS = ["<!DOCTYPE", "<html", "<HTML"]
DEAD_PAGE_MARK = "No interface is running right now"
LIVE_URL_PATTERN = r"https?://[a-z0-9\-]+\.gradio\.live"

# --- Fixed values: log lines -----------------------------------------------
RUN_START = "Triggering pipeline"
RUN_DONE = "pipeline complete!"
RUN_ERROR = "pipeline error"

# --- Fixed values: resume steps (number, name, size floor, must name topic) -
RESUME_STEPS = [
    (1, "script", 0, True),
    (2, "emphasis", TEXT_FLOOR_BYTES, True),
    (3, "voice", MEDIA_FLOOR_BYTES - 1, False),
    (4, "segments", TEXT_FLOOR_BYTES, False),
]

# --- Fixed values: collection titles ---------------------------------------
SUBJECT_COLLECTION = "[{stream}] {subject} Full Course"
CHAPTER_COLLECTION = "{chapter} | {subject}"
NO_TRANSCRIPT = "Transcript unavailable. Description: "

# --- Fixed values: speaking instructions -----------------------------------
INSTRUCT_EMPTY = "Speak clearly and engagingly like a teacher"
INSTRUCT_MISSING = "Speak clearly and engagingly like a teacher explaining to students"
INSTRUCT_SUFFIX = "<|endofprompt|>"
# upper bound of the position (None: the rest), text, speed
INSTRUCT_BANDS = [
    (0.1, "Speak with warm excitement, greeting your audience enthusiastically", 1.0),
    (0.3, "Clear and patient tone, introducing the foundational concept step by step", 0.95),
    (0.7, "Engaged teaching voice, explaining with clarity and building understanding", 0.95),
    (0.9, "Emphasize key takeaways, speaking with conviction and authority", 0.9),
    (None, "Warm and encouraging wrap-up, motivating the audience to keep learning", 1.0),
]

# --- Fixed values: intro and outro texts -----------------------------------
INTROS = [
    "Hey everyone, welcome back to {channel}! Today we're diving deep into {topic} — this is one of those concepts in {subject} that a lot of students struggle with, so I wanted to break it down for you in the simplest way possible. Let's get right into it.",
    "What's up everyone, welcome to {channel}! If you've been studying {subject} and {topic} still confuses you, don't worry — by the end of this video, you'll have a crystal clear understanding. Let's jump in.",
    "Hey there, welcome to {channel}! So a lot of you have been asking me to cover {topic} in {subject}, and I finally got around to making this video. Trust me, once you understand this, everything else in this chapter clicks. Let me explain.",
    "What's going on everyone, welcome back to {channel}! In today's video, we're tackling {topic} — and honestly, this is a game changer for your {subject} preparation. Pay close attention because this will definitely come up in your exams. Here we go.",
    "Hey everybody, welcome to {channel}! Today's topic is {topic} from {subject}. Now I know this sounds intimidating at first, but I promise you — it's actually really intuitive once you see it the right way. Let me walk you through it.",
]
OUTROS = [
    "And that's everything you need to know about {topic}! If this video helped you understand the concept better, make sure to hit that like button and drop a comment below telling me which topic you want me to cover next. Don't forget to subscribe to {channel} and turn on the bell icon so you never miss a new lecture. See you in the next one!",
    "So that wraps up our deep dive into {topic}. I really hope this made things clearer for you. If it did, please like this video — it honestly helps the channel a lot. Subscribe if you haven't already, and let me know in the comments what you'd like to learn next. Until next time, keep studying smart!",
    "Alright, that was {topic} explained from start to finish. If you found this useful, smash that like button and share this video with a friend who's also studying for exams. Subscribe to {channel} for more lectures like this, and I'll catch you in the next video. Take care!",
    "And there you have it — {topic} simplified! Remember, understanding the basics is key to cracking exams. Hit like if this helped, subscribe to {channel} for daily lectures, and comment below with any doubts. I read every single comment. See you soon!",
    "That's a wrap on {topic}! I hope you now feel way more confident about this concept. If you do, show some love — like, comment, and subscribe to {channel}. Every subscription genuinely motivates me to keep making these videos for you. See you in the next one, take care!",
]

# --- Fixed values: title formulas, description, tags -----------------------
TITLES = [
    "Watch This and You'll FINALLY Understand {topic}",
    "{topic} — The Video I WISH I Had Before My Exam",
    "{topic} Explained So Well, You'll Never Forget It",
    "How {topic} ACTUALLY Works ({subject})",
    "I Taught {topic} to 1000 Students — Here's the BEST Way",
    "{topic} in {subject}: Once You See This, It Clicks",
    "Stop Memorizing {topic} — UNDERSTAND It Instead",
    "{topic} | The Only Video You'll Ever Need ({chapter})",
    "Why Most Students Get {topic} WRONG — And How to Fix It",
    "{topic} — From Zero to Hero in One Video",
    "The Secret Behind {topic} That Teachers Don't Tell You",
    "{topic} Made RIDICULOUSLY Simple | {subject}",
]
TITLE_MAX = 100
DESCRIPTION_MAX = 4900
DESCRIPTION = """🚀 {topic} in {subject} — the COMPLETE breakdown you've been looking for!

In this video, we go deep into {chapter}, covering {topic} from the absolute basics to exam-level mastery. Whether you're prepping for semester exams, GATE, placements, or just want to truly understand the concept — this is the one video you need.

📌 What You'll Learn:
• Core definition & intuition behind {topic}
• Step-by-step worked examples with dry runs
• Common mistakes & how to avoid them
• Time & space complexity analysis
• Real interview questions on {topic}

⏱️ Timestamps:
0:00 — Intro & Why {topic} Matters
0:30 — Core Concept Explained
2:00 — Step-by-Step Example
4:30 — Common Mistakes
6:00 — Complexity Analysis
7:30 — Interview Questions & Recap

🔥 If this helped, smash that LIKE button and SUBSCRIBE for daily {subject} videos!

📚 Part of our {chapter} series in {subject}.

{topic_tag} {subject_tag} {chapter_tag} #Education #Engineering #ExamPrep #GATE #Placements #CodingInterview #BTech #CSE #LearnWithMe"""
TAGS = [
    "{topic}",
    "{topic} explained",
    "{topic} in {subject}",
    "{topic} tutorial",
    "{topic} for beginners",
    "{topic} step by step",
    "{topic} with example",
    "{topic} interview questions",
    "{topic} gate",
    "{topic} placement",
    "{chapter}",
    "{chapter} {subject}",
    "{chapter} full chapter",
    "{subject}",
    "{subject} lecture",
    "{subject} class 11",
    "{subject} class 12",
    "{subject} btech",
    "{subject} notes",
    "education",
    "exam prep",
    "semester exam",
    "engineering",
    "ncert",
    "cbse",
    "gate preparation",
    "coding interview",
    "learn with me",
    "study tips",
]
TAG_BUDGET = 495
TAG_OVERHEAD = 3
TAG_MAX = 30

# --- Fixed values: emphasis phrases ----------------------------------------
SUSPENSE_PHRASES = [
    ["the answer is", "the result is", "and the output", "which means", "which gives us", "so the final"],
    ["but here's the thing", "but wait", "but there's more", "now here's where"],
    ["this is where it gets", "this is the key", "this is what makes"],
]
EXCLAIM_PHRASES = [
    ["it works", "it runs", "it sorts", "it completes", "we're done", "we got it", "nailed it", "that's correct", "that's right"],
    ["simple as that", "easy right", "makes sense right", "and that's how", "and that's why", "the answer is"],
]
QUESTION_PHRASES = [
    "why does", "why do", "how does", "how do", "what happens", "what is", "what are",
    "can you see", "do you see", "makes sense",
]
LINE_CONNECTORS = ["Now", "So", "Well", "Right", "Okay", "Alright", "Look", "See", "Remember", "Notice"]
MID_CONNECTORS = [
    "however", "therefore", "furthermore", "moreover", "in other words", "in fact", "actually", "basically",
]
REVEAL_PHRASES = ["and the answer is", "and the result is", "and it turns out", "and here's the thing"]
UPPER_WORDS = ["key", "important", "critical", "remember", "always", "never"]
