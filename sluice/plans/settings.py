"""Configuration used by the registered queries (function arguments in real use)."""

# Route table: event type to topic; 'default' takes every other type.
ROUTES = {
    "default": "events_default",
    "click": "clicks",
    "purchase": "orders",
    "signup": "registrations",
}
# Partner settings (illustrative values, not anyone's real endpoint or key).
PARTNER_KEY = "k3y-for-tests"
PARTNER_PID = "p-001"
CLICK_BASE_URL = "http://partner.example.test/clk"
POSTBACK_BASE_URL = "http://adserver.example.test/postback"
# Registered path prefixes for request dispatch.
PREFIXES = ("/en", "/en/1", "/en/12", "/fr/", "/de/2", "/es/5", "/es/53", "/blog")
