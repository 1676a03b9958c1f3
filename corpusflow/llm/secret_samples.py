"""Labelled strings for the secret scan's character models.

``ORDINARY`` was written down by hand: names, paths, addresses and marks as they stand in programs and prose.
``RANDOM`` are drawn evenly, which is what random strings are.  Kinds that look random and are none (UUIDs,
digests, times, rows of one character) are made up by their own rules and labelled ordinary.  ``split`` keeps every third
string of either label, by its crc32, away from the models.
"""

from __future__ import annotations

import random
import string
import zlib

ORDINARY = """
AbstractSingletonProxyFactoryBean getElementsByClassName ThreadPoolExecutorService addEventListenerOptions XMLHttpRequestEventTarget
NullPointerException IllegalArgumentException ConcurrentModificationException ArrayIndexOutOfBoundsException UnsupportedOperationException
SimpleDateFormatTimezone ApplicationContextAware DataSourceTransactionManager HttpServletRequestWrapper RandomForestClassifier
LogisticRegressionCV train_test_split_stratified mean_absolute_percentage_error maximum_likelihood_estimate softmax_cross_entropy_with_logits
number_of_training_examples learning_rate_schedule batch_normalization_momentum max_position_embeddings attention_probs_dropout_prob
get_user_by_email_address create_database_connection_pool update_shipping_address_line_2 is_valid_session_cookie DEFAULT_MAXIMUM_RETRY_COUNT
MAX_CONNECTIONS_PER_HOST GOOGLE_APPLICATION_CREDENTIALS LD_LIBRARY_PATH_64 PYTHONDONTWRITEBYTECODE CMAKE_BUILD_PARALLEL_LEVEL
kubernetes-dashboard-metrics-scraper nginx-ingress-controller-leader docker-compose-production-override continuous-integration-pipeline react-native-gesture-handler
babel-plugin-transform-runtime eslint-config-airbnb-typescript spring-boot-starter-data-jpa hadoop-mapreduce-client-core jackson-databind-annotations
application/x-www-form-urlencoded application/octet-stream/binary text/html/charset=utf-8 multipart/form-data/boundary usr/local/lib/python3/site-packages
var/log/apache2/error_log_archive home/user/projects/website/static/css/main src/main/java/org/example/service/impl docs/source/reference/api/generated etc/systemd/system/multi-user
org/apache/commons/lang3/StringUtils com/example/project/controller/UserController include/linux/netdevice_features drivers/net/ethernet/intel/e1000 share/doc/packages/libreoffice/readme
www-example-com-blog-2021-03-04-how-to-write-good-tests posts/2019/11/27/thanksgiving-recipes-for-beginners category/science-and-technology/page/12 questions/1732348/regex-match-open-tags wiki/History_of_the_Roman_Empire
en/latest/getting-started/installation news/world-europe-46573892 articles/2018-10-17-market-report-q3 products/kitchen-and-dining/coffee-makers/item-10453 static/images/2020/05/header-background-1920x1080
Donaudampfschifffahrtsgesellschaft Rindfleischetikettierungsgesetz Geschwindigkeitsbegrenzung Arbeitsunfaehigkeitsbescheinigung Bundesverfassungsgericht
Verantwortungsbewusstsein Krankenversicherungskarte Wirtschaftswissenschaften Unabhaengigkeitserklaerung Lebensmittelverpackungen
anticonstitutionnellement internationalisation-des-entreprises institutionnalisation developpement-durable-et-environnement responsabilite-professionnelle
desafortunadamente-para-todos electroencefalografista responsabilidad-administrativa internacionalizacion anticonstitucionalidad
counterrevolutionaries electroencephalographically uncharacteristically disproportionately internationalization
incomprehensibilities antidisestablishmentarianism pseudopseudohypoparathyroidism state-of-the-art-technology mother-in-law-and-father-in-law
once-in-a-lifetime-opportunity not-for-profit-organisations twenty-first-century-literature well-known-and-often-quoted matter-of-fact-description
Mozilla/5/Windows/NT/10/AppleWebKit/537/KHTML/like/Gecko Chrome/96/0/4664/110/Safari/537 python-requests/2/25/1 openjdk-11-jre-headless-amd64 linux-image-5-10-0-21-amd64
release-2022-09-30-hotfix-3 version-10-15-7-build-19H2 feature/JIRA-1234-add-user-export bugfix/issue-5521-null-check chapter-12-section-3-paragraph-2
ISBN-978-3-16-148410-0 DE89-3704-0044-0532-0130-00 tel-0049-30-1234567-89 order-2023-000123456-01 invoice_number_20230405_0017
0123456789012345678901234567890 1234567890123456789012345 11111111111111111111 3-14159265358979323846 2-71828182845904523536
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz abcdefghijklmnopqrstuvwxyz0123456789 ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 qwertyuiopasdfghjklzxcvbnm
aaaaaaaaaaaaaaaaaaaaaaaa hahahahahahahahahahaha loooooooooooooooooooool AAAAAAAAAAAAAAAAAAAAAAAAAA xxxxxxxxxxxxxxxxxxxxxxxx
THIS_IS_A_LONG_CONSTANT_NAME SELECT_COUNT_FROM_CUSTOMERS_WHERE END_OF_TRANSMISSION_BLOCK ERROR_FILE_NOT_FOUND_EXCEPTION HTTP_STATUS_NOT_ACCEPTABLE
ObjectRelationalMappingStrategy BinarySearchTreeIterator DepthFirstSearchVisitor AsynchronousFileChannelProvider GenericObjectPoolConfiguration
org-springframework-security-oauth2-config sklearn-preprocessing-standard-scaler numpy-testing-assert-array-almost-equal matplotlib-pyplot-tight-layout pandas-core-groupby-generic
userAuthenticationTokenProvider customerBillingAddressPostalCode shoppingCartCheckoutButtonLabel previousTransactionTimestamp remainingSubscriptionDays
test_that_empty_input_returns_none test_case_17_handles_unicode should_not_raise_when_list_is_empty it_returns_404_for_missing_pages benchmark_sort_1000000_integers
""".split()

#: Words that further identifiers are put together from.
WORDS = (
    "about after again all also and another any are back because been before between both but can case change check class "
    "client close code config connection content context copy count create current data date default delete directory document "
    "each end error event every example false field file find first for format from function get group handle have header "
    "index info input instance into item key label language last length level line list local log long make manager many map "
    "message method model more most name network new next node not number object off only open option order other output over "
    "page parent part path people place point position process public query read record remove report request reset response "
    "result right row same search section select server service session set should show since size some source start state "
    "aber alle auch auf aus bei dann das dass dem den der die durch ein eine einer haben ich ihre immer ist kann kein mehr "
    "nach nicht noch nur oder schon sein sich sind und unter von vor war werden wie wird zeit zu zwischen "
    "avec aussi autre bien cette comme dans depuis des deux elle encore entre est faire leur mais nous ou par pas "
    "plus pour quand que qui sans ses son sont sous sur tous tout vous "
    "algo antes aunque como con contra cuando desde donde dos ella entre era esta este estos hasta hay los menos mismo muy "
    "nos otro para pero poco porque puede ser sin sobre tanto tiene todo una uno ver vez"
).split()
HEXDIGITS = "0123456789abcdef"


def drawn(seed: int = 7, n: int = 4000) -> list[str]:
    """Random strings over the alphabets that keys are made of; hexadecimal ones are a matter of the fixed patterns."""
    rng = random.Random(seed)
    both = string.ascii_letters + string.digits
    alphabets = (both, both + "+/", both + "_-", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits, string.ascii_letters)
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 64))) for i in range(n)]


def made_up(seed: int = 8, n: int = 4000) -> list[str]:
    """Ordinary strings: words put together, UUIDs, digests with and without their names, times, rows of one character."""
    rng = random.Random(seed)
    digits = lambda alphabet, k: "".join(rng.choices(alphabet, k=k))
    out = []
    for i in range(n):
        kind = i % 8
        if kind == 0:
            h = digits(HEXDIGITS, 32)
            h = h.upper() if i % 24 == 0 else h
            out.append("-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:])))
        elif kind == 1:
            name, size = rng.choice((("md5", 32), ("sha1", 40), ("sha256", 64), ("sha512", 128), ("", 40), ("", 64)))
            out.append(name + rng.choice(":-=")[: len(name)] + digits(HEXDIGITS, size))
        elif kind == 2 and i % 16 == 2:
            out.append(rng.choice("-_=/" * 10 + string.ascii_letters + string.digits) * rng.randint(20, 60))
        elif kind == 2:
            out.append(f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}T{rng.randint(0, 23):02d}-{rng.randint(0, 59):02d}-{rng.randint(0, 59):02d}-{rng.randint(0, 999999):06d}Z")
        else:
            part = rng.choices(WORDS, k=rng.randint(4, 8))
            part = [w.title() for w in part] if i % 5 == 1 else [w.upper() for w in part] if i % 5 == 2 else part
            text = rng.choice(("_", "", "-", "/", "_")).join(part)
            out.append(text + (rng.choice(("", "_", "-")) + str(rng.choice((1, 2, 3, 10, 42, 100, 1999, 2015, 2024, 20240131))) if i % 3 == 0 else ""))
    return out


def split(strings: list[str]) -> tuple[list[str], list[str]]:
    """(to learn from, held out)."""
    held = lambda s: zlib.crc32(s.encode()) % 3 == 0
    return [s for s in strings if not held(s)], [s for s in strings if held(s)]
