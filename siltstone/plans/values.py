"""Fixed values of the census: platform signatures, country names, buckets and excluded domains."""

from __future__ import annotations

from typing import NamedTuple


class Engine(NamedTuple):
    """A platform and what gives it away, in lower case."""

    category: str
    name: str
    generator: tuple[str, ...]
    html: tuple[str, ...]
    url: tuple[str, ...]


# Engines in order of precedence; the first that matches wins.
# (category, name, in the generator tag, in the page, in the URL)
ENGINES: tuple[Engine, ...] = (
    Engine("Forum", "phpBB", ("phpbb",), ("powered by phpbb",), ("viewtopic.php", "viewforum.php")),
    Engine("Forum", "vBulletin", ("vbulletin",), ("powered by vbulletin",), ("showthread.php", "forumdisplay.php")),
    Engine("Forum", "SMF", ("simple machines",), ("powered by smf", "simple machines forum"), ("index.php?board", "index.php?topic")),
    Engine("Forum", "XenForo", ("xenforo",), ("powered by xenforo",), ("/threads/", "/forums/")),
    Engine("Forum", "MyBB", ("mybb",), ("powered by mybb",), ("showthread.php?tid",)),
    Engine("Forum", "Discourse", ("discourse",), ("discourse-application",), ()),
    Engine("Forum", "Flarum", ("flarum",), ("flarum",), ()),
    Engine("Forum", "NodeBB", ("nodebb",), ("nodebb",), ()),
    Engine("Forum", "Invision Community", ("invision",), ("powered by invision", "ipsfocus"), ()),
    Engine("E-commerce", "WooCommerce", (), ("wp-content/plugins/woocommerce", "woocommerce-page"), ()),
    Engine("E-commerce", "Shopify", ("shopify",), ("cdn.shopify.com", "myshopify.com", "shopify.theme"), ()),
    Engine("E-commerce", "Magento", ("magento",), ("/skin/frontend/", "mage/cookies", "magento_", "/static/version"), ()),
    Engine("E-commerce", "PrestaShop", ("prestashop",), ("prestashop", "/modules/ps_"), ()),
    Engine("E-commerce", "OpenCart", ("opencart",), ("catalog/view/theme", "opencart"), ("route=product/", "route=common")),
    Engine("E-commerce", "BigCommerce", (), ("cdn11.bigcommerce.com", "bigcommerce.com/stencil"), ()),
    Engine("E-commerce", "Ecwid", (), ("app.ecwid.com", "ecwid_"), ()),
    Engine("E-commerce", "InSales", ("insales",), ("static.insales", "insales.ru"), ()),
    Engine("E-commerce", "VirtueMart", (), ("virtuemart",), ("option=com_virtuemart",)),
    Engine("Site Builder", "Wix", ("wix.com",), ("static.wixstatic.com", "wixsite.com", "wix-warmup-data"), ()),
    Engine("Site Builder", "Squarespace", ("squarespace",), ("static1.squarespace.com", "squarespace-cdn.com", "squarespace.com"), ()),
    Engine("Site Builder", "Webflow", ("webflow",), ("assets.website-files.com", "assets-global.website-files.com"), ()),
    Engine("Site Builder", "Weebly", ("weebly",), ("cdn2.editmysite.com", "weebly.com"), ()),
    Engine("Site Builder", "Tilda", ("tilda",), ("static.tildacdn.com", "tilda.ws", "tildacdn"), ()),
    Engine("Site Builder", "Jimdo", ("jimdo",), ("jimdo.com", "jimstatic.com"), ()),
    Engine("Site Builder", "Google Sites", (), ("sites.google.com", "gstatic.com/_/sites"), ()),
    Engine("Image Comment", "Coppermine", (), ("coppermine photo gallery",), ("displayimage.php",)),
    Engine("Image Comment", "Piwigo", ("piwigo",), ("powered by piwigo",), ()),
    Engine("Image Comment", "Gallery", ("gallery",), ("powered by gallery",), ("/gallery2/", "/main.php?g2_")),
    Engine("Image Comment", "Zenphoto", ("zenphoto",), ("powered by zenphoto",), ()),
    Engine("Guestbook", "Advanced Guestbook", (), ("advanced guestbook",), ("addentry.php",)),
    Engine("Guestbook", "Generic Guestbook", (), ("sign the guestbook", "view the guestbook", "guestbook entries"), ("guestbook.cgi", "gbook.php", "signbook.php")),
    Engine("Trackback", "Movable Type Trackback", (), ("send trackback",), ("mt-tb.cgi",)),
    Engine("Trackback", "WordPress Trackback", (), ("trackback ping", "trackback url"), ("/trackback/", "wp-trackback.php")),
    Engine("Microblog", "Tumblr", ("tumblr",), ("tumblr.com/theme", "assets.tumblr.com"), ()),
    Engine("Microblog", "Mastodon", ("mastodon",), ('id="mastodon"', "id='mastodon'"), ("/api/v1/instance",)),
    Engine("Microblog", "GNU Social", ("statusnet", "gnu social"), ("powered by gnu social",), ()),
    Engine("Social Network", "BuddyPress", ("buddypress",), ("buddypress",), ("/members/",)),
    Engine("Social Network", "Elgg", ("elgg",), ("powered by elgg", "elgg.config"), ()),
    Engine("Social Network", "PHPFox", ("phpfox",), ("powered by phpfox",), ()),
    Engine("Social Network", "Dolphin", ("dolphin",), ("powered by dolphin",), ()),
    Engine("Social Network", "Oxwall", ("oxwall",), ("powered by oxwall",), ()),
    Engine("Directory", "PHP Link Directory", (), ("powered by php link directory", "phpld"), ("/listing/", "add-url.php")),
    Engine("Directory", "Generic Directory", (), ("submit your link", "link directory", "business directory"), ("/directory/", "submit-link")),
    Engine("Article", "Article Dashboard", (), ("powered by article dashboard",), ()),
    Engine("Article", "ArticleFriendly", (), ("powered by articlefriendly",), ()),
    Engine("Blog Comment", "Blogger", ("blogger",), ("blogspot.com", ".blogger.com"), ()),
    Engine("Blog Comment", "Movable Type", ("movable type",), ("powered by movable type",), ("mt-comments.cgi",)),
    Engine("Blog Comment", "LiveJournal", (), ("livejournal.com", "lj-cut"), ()),
    Engine("CMS", "Joomla", ("joomla",), ("/media/jui/", "/media/system/js/", "option=com_content", "joomla-script-options"), ("option=com_",)),
    Engine("CMS", "Drupal", ("drupal",), ("drupal-settings-json", "sites/default/files", "/sites/all/", "data-drupal"), ()),
    Engine("CMS", "TYPO3", ("typo3",), ("typo3temp", "typo3conf", "t3-"), ()),
    Engine("CMS", "1C-Bitrix", ("1c-bitrix", "bitrix site manager"), ("/bitrix/js", "/bitrix/templates", "/bitrix/cache", "bx-core"), ()),
    Engine("CMS", "DataLife Engine", ("datalife engine",), ("dle_root", "engine/classes", "datalife engine"), ()),
    Engine("CMS", "uCoz", ("ucoz",), ("ucoz.net", "ucoz.ru", ".ucoz."), ()),
    Engine("CMS", "Ghost", ("ghost",), ("ghost-url", "/assets/built/"), ()),
    Engine("CMS", "MODX", ("modx",), ("modx", "assets/components/"), ()),
    Engine("CMS", "Concrete CMS", ("concrete5", "concrete cms"), ("/concrete/js/", "ccm-page"), ()),
    Engine("CMS", "DNN", ("dotnetnuke",), ("/desktopmodules/", "dnn_"), ()),
    Engine("CMS", "Sitecore", (), ("/sitecore/", "sc_site", "-/media/"), ()),
    Engine("CMS", "ExpressionEngine", ("expressionengine",), ("expressionengine",), ()),
    Engine("CMS", "WordPress", ("wordpress",), ("wp-content", "wp-includes", "wp-json"), ("wp-comments-post.php", "/wp-content/")),
)

# Buckets and their top-level domains; each domain is in one bucket.
BUCKETS: dict[str, str] = {
    "🌎 Латинская Америка": "bz bo cr cu do sv gt gy ht hn jm ni pa py sr tt ve pr",
    "🇺🇸 США": "com us ca",
    "🇷🇺 Россия": "ru",
    "🇻🇳 Вьетнам": "vn",
    "🇵🇹 Португалия": "pt",
    "🇹🇷 Турция": "tr",
    "🇬🇧 Великобритания": "uk",
    "🇯🇵 Япония": "jp",
    "🇮🇳 Индия": "in",
    "🇩🇪 Германия": "de",
    "🇧🇷 Бразилия": "br",
    "🇦🇺 Австралия": "au nz nu tv",
    "🇿🇦 Южная Африка": "ao bj bw bf bi cm cf td cg cd ci gq er sz et ga gm gh gn gw ke ls lr mg mw ml mz na ne ng rw sn sl za ss tz tg ug zm zw cv",
    "🌍 Арабские страны": "dz bh km dj eg iq jo kw lb ly mr ma om ps qa sa so sd sy tn ae ye eh",
    "🇫🇷 Франция": "fr",
    "🇪🇸 Испания": "es",
    "🇪🇺 Другие страны Европы": "al ad at be ba bg hr cy cz dk ee fi gr hu is ie lv li lt lu mt mc me nl mk no ro sm rs sk si se ch va bv",
    "🇵🇱 Польша": "pl",
    "🇮🇩 Индонезия": "id",
    "🇮🇹 Италия": "it",
    "🇵🇰 Пакистан": "pk",
    "🇲🇾 Малайзия": "my",
    "🇸🇬 Сингапур": "sg",
    "🇵🇭 Филиппины": "ph",
    "🌍 Другие страны Африки": "sc mu re yt sh st",
    "🇨🇳 Китай": "cn hk mo tw",
    "🇨🇴 Колумбия": "co",
    "🇨🇱 Чили": "cl",
    "🇵🇪 Перу": "pe",
    "🇪🇨 Эквадор": "ec",
    "🇺🇾 Уругвай": "uy",
    "🇹🇭 Таиланд": "th",
    "🇰🇷 Корея": "kr kp",
    "🇲🇽 Мексика": "mx",
    "🌐 СНГ": "am az by kz kg md tj tm uz ua ge",
    "🇦🇷 Аргентина": "ar",
    "🌏 Другие страны Азии": "af bd bt bn kh ir il mv mn mm np lk tl la io",
}

# Country of a top-level domain.
COUNTRIES: dict[str, str] = {
    "ru": "Russia", "ua": "Ukraine", "by": "Belarus", "kz": "Kazakhstan", "us": "United States", "uk": "United Kingdom", "de": "Germany",
    "fr": "France", "it": "Italy", "es": "Spain", "pt": "Portugal", "nl": "Netherlands", "be": "Belgium", "ch": "Switzerland", "at": "Austria",
    "se": "Sweden", "no": "Norway", "dk": "Denmark", "fi": "Finland", "pl": "Poland", "cz": "Czech Republic", "sk": "Slovakia", "hu": "Hungary",
    "ro": "Romania", "bg": "Bulgaria", "gr": "Greece", "tr": "Turkey", "ie": "Ireland", "is": "Iceland", "lt": "Lithuania", "lv": "Latvia",
    "ee": "Estonia", "cn": "China", "jp": "Japan", "kr": "South Korea", "in": "India", "id": "Indonesia", "th": "Thailand", "vn": "Vietnam",
    "ph": "Philippines", "my": "Malaysia", "sg": "Singapore", "pk": "Pakistan", "bd": "Bangladesh", "br": "Brazil", "mx": "Mexico", "ar": "Argentina",
    "cl": "Chile", "co": "Colombia", "pe": "Peru", "ve": "Venezuela", "uy": "Uruguay", "ec": "Ecuador", "bo": "Bolivia", "py": "Paraguay",
    "cr": "Costa Rica", "pa": "Panama", "gt": "Guatemala", "hn": "Honduras", "sv": "El Salvador", "ni": "Nicaragua", "do": "Dominican Republic",
    "cu": "Cuba", "pr": "Puerto Rico", "ca": "Canada", "au": "Australia", "nz": "New Zealand", "za": "South Africa", "eg": "Egypt", "ng": "Nigeria",
    "ke": "Kenya", "ma": "Morocco", "sa": "Saudi Arabia", "ae": "United Arab Emirates", "il": "Israel", "ir": "Iran", "iq": "Iraq", "hk": "Hong Kong",
    "tw": "Taiwan", "ad": "Andorra", "al": "Albania", "am": "Armenia", "az": "Azerbaijan", "ba": "Bosnia and Herzegovina", "bf": "Burkina Faso",
    "bi": "Burundi", "bj": "Benin", "bv": "Bouvet Island", "cd": "DR Congo", "cf": "Central African Republic", "cg": "Congo", "cv": "Cape Verde",
    "cy": "Cyprus", "dj": "Djibouti", "eh": "Western Sahara", "er": "Eritrea", "ga": "Gabon", "ge": "Georgia", "gm": "Gambia", "gn": "Guinea",
    "gq": "Equatorial Guinea", "gw": "Guinea-Bissau", "hr": "Croatia", "io": "British Indian Ocean Territory", "km": "Comoros", "kp": "North Korea",
    "li": "Liechtenstein", "lr": "Liberia", "ls": "Lesotho", "lu": "Luxembourg", "mc": "Monaco", "md": "Moldova", "me": "Montenegro",
    "mk": "North Macedonia", "mo": "Macau", "mr": "Mauritania", "mt": "Malta", "ne": "Niger", "nu": "Niue", "re": "Reunion", "rs": "Serbia",
    "sc": "Seychelles", "sh": "Saint Helena", "si": "Slovenia", "sl": "Sierra Leone", "sm": "San Marino", "so": "Somalia", "ss": "South Sudan",
    "st": "Sao Tome and Principe", "sz": "Eswatini", "td": "Chad", "tg": "Togo", "tl": "Timor-Leste", "tv": "Tuvalu", "va": "Vatican",
    "yt": "Mayotte", "bz": "Belize", "gy": "Guyana", "sr": "Suriname", "ht": "Haiti", "jm": "Jamaica", "tt": "Trinidad and Tobago", "bb": "Barbados",
    "bs": "Bahamas", "dz": "Algeria", "tn": "Tunisia", "ly": "Libya", "sd": "Sudan", "gh": "Ghana", "tz": "Tanzania", "ug": "Uganda",
    "et": "Ethiopia", "sn": "Senegal", "ci": "Cote d'Ivoire", "cm": "Cameroon", "zm": "Zambia", "zw": "Zimbabwe", "ao": "Angola", "mz": "Mozambique",
    "rw": "Rwanda", "bw": "Botswana", "na": "Namibia", "ml": "Mali", "mg": "Madagascar", "mu": "Mauritius", "mw": "Malawi", "lk": "Sri Lanka",
    "np": "Nepal", "mm": "Myanmar", "kh": "Cambodia", "la": "Laos", "mn": "Mongolia", "uz": "Uzbekistan", "kg": "Kyrgyzstan", "tj": "Tajikistan",
    "tm": "Turkmenistan", "af": "Afghanistan", "bt": "Bhutan", "bn": "Brunei", "mv": "Maldives", "kw": "Kuwait", "qa": "Qatar", "bh": "Bahrain",
    "om": "Oman", "jo": "Jordan", "lb": "Lebanon", "sy": "Syria", "ye": "Yemen", "ps": "Palestine",
}

# Platforms that are services of their own; they and their subdomains are left out.
EXCLUDED: tuple[str, ...] = (
    "facebook.com",
    "fb.com",
    "fb.watch",
    "instagram.com",
    "twitter.com",
    "x.com",
    "t.co",
    "telegram.org",
    "telegram.me",
    "t.me",
    "youtube.com",
    "youtu.be",
    "tiktok.com",
    "linkedin.com",
    "pinterest.com",
    "reddit.com",
    "whatsapp.com",
    "snapchat.com",
    "discord.com",
    "discord.gg",
    "wechat.com",
    "line.me",
    "viber.com",
)
