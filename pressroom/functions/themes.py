"""Theme keywords of the classification prompt and the prompt template."""

from __future__ import annotations

# The theme keyword list exactly as the reference keeps it --
# one keyword per line, in order; trailing spaces are part of the keyword.
THEME_TEXT = """
Технологии
Инновации
Innovations
Trends
Цифровизация
Автоматизация
Цифровая трансформация
Digital solutions
Цифровые двойники
Digital twins
ИИ 
AI
IoT 
Интернет вещей
Big Data
Блокчейн
Process mining
Облачные технологии
Квантовые вычисления
Смарт-контракты
Робототехника
VR/AR/MR 
Виртуальная и дополненная реальность
Генеративный
Распознавание
Искусственный интеллект
Машинное обучение
Глубокое обучение
Нейронные сети
Компьютерное зрение
Обработка естественного языка (NLP)
Reinforcement Learning 
Low-code
No-code
Металлургический(ая)
Сталь
Steel
LLM
ML
ChatGPT
IT
Кибербезопасность
Стартапы
Startups
YandexGPT
LLAMA
GPT (GPT-3, GPT-4)
BERT
OpenAI
DALL·E
Transformer models
Generative Adversarial Networks (GAN)
DeepFake 
Машинное зрение
Text-to-Image
Voice-to-text 
Визуализация данных 
Управление цепочками поставок
Снабжение
Технологии 5G
Суперкомпьютеры
DevOps
ФинТех
Token
Токен
Микросервисы
Kubernetes
API 
Цифровой след
Цифровая идентификация
Интеллектуальный анализ данных
Продвинутая аналитика
Северсталь
Евраз
ММК
ОМК
Nippon steel
"""

# Fixed value: the classification prompt template ({themes} and {text} are
# filled in; the model answers with a theme code, 0 when none fits).
PROMPT_PREFIX = "Определи, к какой из предложенных тем: "
PROMPT_MIDDLE = " относится этот текст: "
PROMPT_SUFFIX = " и дай численный ответ в виде кода темы, если ни одна тема не подходит, то дай ответ 0"


def keywords() -> list[str]:
    """Split the list on newlines and drop empty entries (no trimming)."""
    return [k for k in THEME_TEXT.split("\n") if k]


def themes_joined() -> str:
    return ",".join(keywords())
