"""Models (staging -> intermediate -> dimensions -> facts) and reports."""
