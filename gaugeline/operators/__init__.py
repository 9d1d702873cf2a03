"""DataFrame operators: every public function takes frames and returns frames, without actions."""
